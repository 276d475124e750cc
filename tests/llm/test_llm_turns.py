"""Operators on conversations: repair and prefix trie."""

import random

import brute
import compare
import numpy as np
import pytest

from linetally.llm import oracle, queries, repair, turn_trie

TURNS = "conv_id long, turn long, role string, text string"


def awkward_turns(spark, seed=4, n=400):
    """Conversations with nulls everywhere, equal turns, repeats, copies, and clashing names."""
    rng = random.Random(seed)
    texts = [None, "", " \n", "yes.", "no", "why?", "a ", "x" * 50_000 + "!", "é\U0001f600.", "one\ntwo!\n "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = [
        (rng.choice([None, *range(40)]), rng.choice([None, *range(6), 2**40]), rng.choice(roles), rng.choice(texts))
        for _ in range(n)
    ]
    frame = spark.createDataFrame(rows + rows[:30], TURNS)
    for i, name in enumerate(["kind", "digest", "present", "fault", "again", "edit", "node", "depth", "family", "a.b"]):
        frame = frame.selectExpr("*", f"{i} as `{name}`")
    return frame.selectExpr("*", "map(1, 2) as m")


def turns_connection(rows):
    import duckdb

    con = duckdb.connect()
    con.register("given", rows.select("conv_id", "turn", "role", "text").toArrow())
    con.execute("create view conversations as select * from given")
    return con


def cheapest(turns):
    """The least (cost, audit) over all repairs, by dynamic programming over the last role."""
    keeps = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

    def with_inserts(labels):
        labels = dict(labels)
        for _ in range(3):
            for state, (cost, audit) in list(labels.items()):
                after = 3 if state == 2 else 2
                labels[after] = min(labels.get(after, (10**9, "")), (cost + 2, audit + "I"))
        return labels

    labels = {0: (0, "")}
    for turn in turns:
        moves = []
        for state, (cost, audit) in with_inserts(labels).items():
            moves.append((state, cost + 3, audit + "D"))
            if turn.fault not in ("blank", "duplicate"):
                stays = cost + (turn.fault == "truncated")
                moves.append((3 if state == 2 else 2, stays + 2, audit + "R"))
                if (turn.initial, state) in keeps:
                    moves.append((keeps[turn.initial, state], stays, audit + "K"))
        labels = {}
        for state, cost, audit in moves:
            labels[state] = min(labels.get(state, (10**9, "")), (cost, audit))
    labels = with_inserts(labels)
    return min(labels[state] for state in (0, 3) if state in labels)


@pytest.mark.parametrize("block_rows", [1, 3, repair.BLOCK_ROWS])
def test_search_finds_the_cheapest_repair(block_rows):
    rng = random.Random(block_rows)
    for n in range(1200):
        weights = rng.choice([[5, 5, 1, 1, 1], [1, 1, 1, 1, 1], [9, 1, 1, 0, 0], [1, 0, 0, 0, 0], [0, 0, 1, 0, 0]])
        roles = rng.choices(["user", "assistant", "system", "tool", ""], weights, k=n % 90)
        faults = rng.choices([None, "blank", "duplicate", "truncated"], [6, 1, 1, 2], k=len(roles))
        turns = [repair.Turn(role, "x", role[:1], fault) for role, fault in zip(roles, faults, strict=True)]
        work, edits = repair.Repair(block_rows), []
        for number, turn in enumerate(turns):
            edits += work.add(number, turn)
        edits += work.end()
        assert (work.cost, "".join(edit for edit, _, _ in edits)) == cheapest(turns)
        result = "".join(role[:1] for edit, role, _ in edits if edit != "D")
        assert result == "" or result.removeprefix("s") == "ua" * (len(result.removeprefix("s")) // 2)


def test_bounds_never_exceed_the_cost():
    rng = random.Random(8)
    for _ in range(2000):
        roles = rng.choices(["user", "assistant", "system", "tool"], k=rng.randint(0, 9))
        turns = [repair.Turn(r, "x", r[:1], rng.choice([None, "blank", "truncated"])) for r in roles]
        assert repair.lower_bounds(turns)[0] <= cheapest(turns)[0]


def test_repair_matches_sql(spark, sf_dir):
    sql = oracle.repair_sql()
    assert compare.assert_same(queries.op11_repair(spark, sf_dir), compare.connect(sf_dir), sql) == 100


@pytest.mark.parametrize("block_rows", [2, repair.BLOCK_ROWS])
def test_repair_awkward(spark, block_rows):
    rows = awkward_turns(spark)
    report = repair.repair_report(*repair.damaged(rows), block_rows)
    assert compare.assert_same(report, turns_connection(rows), oracle.repair_sql()) == 41
    assert repair.repair_report(rows.limit(0)).count() == 0


def test_repaired_turns_hold_the_result(spark):
    rows = awkward_turns(spark, 5)
    report = {r.conv_id: r for r in repair.repair_report(rows).collect()}
    lines, audits = {}, {}
    for r in repair.repaired_turns(rows).collect():
        if r.edit is None:
            assert report[r.conv_id].audit == "".join(audits.get(r.conv_id, []))
            assert report[r.conv_id].repaired_sha256 == brute.sha("\n".join(lines.get(r.conv_id, [])))
            continue
        audits.setdefault(r.conv_id, []).append(r.edit)
        if r.edit != "D":
            lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert len(report) == 41


def test_long_conversation_is_streamed(spark):
    n = 20_000
    rows = spark.range(n).selectExpr("7L as conv_id", "id as turn", "if(id % 3 = 0, 'assistant', 'user') as role", "concat(id, '.') as text")
    report = repair.repair_report(rows).first()
    want = cheapest([repair.Turn.of("user" if i % 3 else "assistant", f"{i}.", False) for i in range(n)])
    assert (report.cost, report.audit) == want


# op13


def test_centroid_roll_up_sums_subtrees():
    rng = random.Random(6)
    for n in range(300):
        shape = n % 3  # any tree, a chain, a star
        parents = [-1] + [rng.randrange(i) if shape == 0 else i - 1 if shape == 1 else 0 for i in range(1, n)]
        values = np.array([[rng.randrange(9) for _ in range(n)] for _ in range(2)], np.int64).reshape(2, n)
        want = values.copy()
        for node in range(n - 1, 0, -1):
            want[:, parents[node]] += want[:, node]
        assert (turn_trie.roll_up(parents[:n], values) == want).all()


@pytest.mark.parametrize("component_nodes", [1, 7, turn_trie.COMPONENT_NODES])
def test_trie_matches_sql(spark, sf_dir, component_nodes):
    rows = queries.table(spark, sf_dir, "conversations").where("conv_id < 60")
    got = turn_trie.prefix_trie(turn_trie.rebuilt_turns(rows), component_nodes)
    assert compare.assert_same(got, turns_connection(rows), oracle.turn_trie_sql()) > 100


def test_trie_query(spark, sf_dir):
    got = queries.op13_turn_trie(spark, sf_dir)
    assert compare.assert_same(got, compare.connect(sf_dir), oracle.turn_trie_sql()) > 250


def test_trie_awkward(spark):
    rows = awkward_turns(spark, 6)
    got = turn_trie.prefix_trie(turn_trie.rebuilt_turns(rows), 20)
    assert compare.assert_same(got, turns_connection(rows), oracle.turn_trie_sql()) > 100
    assert turn_trie.prefix_trie(turn_trie.rebuilt_turns(rows.limit(0))).count() == 0


def test_trie_of_conversations_as_they_are(spark):
    turns = [(c, t, "user", text) for c, texts in enumerate(["ab", "ab", "ac", "abd", "b"]) for t, text in enumerate(texts)]
    rows = {(r.depth, r.conv_id): r for r in turn_trie.prefix_trie(turn_trie.ordered_turns(spark.createDataFrame(turns, TURNS))).collect()}
    root = rows[0, 0]
    assert len(rows) == 6 and (root.n_convs, root.n_children, root.n_leaves, root.parent_conv_id) == (5, 2, 3, None)
    assert root.saved_tokens == 3 + 2 and rows[2, 0].ends_sha256 == brute.sha("0,1") and rows[3, 3].parent_conv_id == 0


def test_trie_of_a_long_and_a_common_conversation(spark):
    rows = spark.range(3000).selectExpr("10L as conv_id", "id as turn", "'user' as role", "cast(id as string) as text")
    same = spark.range(400).selectExpr("id * 5 + 100 as conv_id", "0L as turn", "'user' as role", "'hi' as text")
    turns = turn_trie.ordered_turns(rows.unionByName(same))
    got = {(r.depth, r.conv_id): r for r in turn_trie.prefix_trie(turns, 500).collect()}
    assert len(got) == 3002 and all(r.n_leaves == 1 for key, r in got.items() if key[0] > 0)
    assert got[0, 10].saved_tokens == 399 * 2 and got[0, 10].n_leaves == 2 and got[1, 100].n_convs == 400
    assert got[1, 100].ends_sha256 == brute.sha(",".join(str(5 * i + 100) for i in range(400)))
