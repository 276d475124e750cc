"""A small plant with results worked out by hand (FIXTURES.md, section 3)."""

MACHINES = [(1, 10, "a"), (2, 10, "b"), (3, 11, "c")]

EVENTS = [
    (0, 3, "2024-01-01 12:00:00", "RUN", None, None),
    (1, 1, "2024-01-01 00:00:00", "RUN", None, None),
    (2, 1, "2024-01-01 10:00:00", "STOP", "MECH", None),
    (3, 1, "2024-01-01 10:30:00", "RUN", None, None),
    (4, 1, "2024-01-01 22:00:00", "RUN", None, None),
    (5, 1, "2024-01-02 01:00:00", "STOP", None, None),
    (6, 1, "2024-01-02 02:00:00", "RUN", None, None),
    (7, 2, "2024-01-01 08:00:00.100000", "RUN", None, None),
    (8, 2, "2024-01-01 20:00:00", "STOP", "ELEC", None),
    (9, 3, "2024-01-02 06:00:00", "STOP", "CHNG", None),
    (10, 3, "2024-01-02 06:30:00", "RUN", None, None),
    (11, 9, "2024-01-01 00:00:00", "STOP", "QUAL", None),
    (12, 9, "2024-01-01 00:30:00", "RUN", None, None),
]

DURATION_US = {
    0: 1080 * 60_000_000,
    1: 600 * 60_000_000,
    2: 30 * 60_000_000,
    3: 690 * 60_000_000,
    4: 180 * 60_000_000,
    5: 60 * 60_000_000,
    6: 0,
    7: 43_199_900_000,
    8: 0,
    9: 30 * 60_000_000,
    10: 0,
    11: 30 * 60_000_000,
    12: 0,
}


def run(order, line, end, good, scrap):
    day = end[:10]
    return (
        order,
        line,
        1,
        f"{day} 00:00:00",
        f"{day} 00:30:00",
        f"{day} 00:00:00",
        end,
        good,
        scrap,
        "unit",
    )


RUNS = [
    run(1, 10, "2024-01-01 14:00:00", 900, 100),
    run(2, 10, "2024-01-01 15:00:00", 190, 10),
    run(3, 10, "2024-01-03 01:00:00", 500, 0),
    run(4, 11, "2024-01-02 12:00:00", 0, 0),
    run(5, 11, "2024-01-01 18:00:00", 0, 7),
]

CUSTOMERS = [(1, "A"), (2, "A"), (3, "B")]

SHIPMENTS = [
    (1, 1, 1, 1, "2024-01-10", "2024-01-10", 5),
    (2, 2, 1, 2, "2024-01-10", "2024-01-13", 5),
    (3, 1, 1, 3, "2024-01-10", "2024-01-08", 5),
    (4, 3, 1, 4, "2024-01-01", "2024-01-02", 5),
]
