"""Registry hygiene: names, coverage of the survey's operator inventory."""

import re

from pixelframe.plans.registry import all_queries

# S6 (column-type report) does no data work, so it is tested, not registered.
UNREGISTERED = {"S6"}


def _ids(items: str) -> set[str]:
    out = set()
    for it in items.split(","):
        m = re.fullmatch(r"([A-Z])(\d+)-[A-Z](\d+)", it)
        if m:
            out |= {f"{m.group(1)}{i}" for i in range(int(m.group(2)), int(m.group(3)) + 1)}
        else:
            out.add(it)
    return out


def test_every_inventory_item_is_registered():
    claimed = set().union(*(_ids(q.items) for q in all_queries().values()))
    inventory = ([f"S{i}" for i in range(1, 10)] + [f"G{i}" for i in range(1, 12)]
                 + [f"P{i}" for i in range(1, 14)] + [f"A{i}" for i in range(1, 14)]
                 + ["O1", "O2"] + [f"X{i}" for i in range(1, 5)] + [f"T{i}" for i in range(1, 5)]
                 + [f"M{i}" for i in range(1, 5)] + [f"U{i}" for i in range(1, 6)]
                 + [f"E{i}" for i in range(1, 6)])
    assert sorted(set(inventory) - claimed - UNREGISTERED) == []


def test_query_names():
    for name in all_queries():
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
        assert not re.match(r"op\d+_", name) and name != "pipeline"
