"""A plain, unoptimised reading of BR-21 for tests."""

from __future__ import annotations

import datetime as dt


def walk(flights, services):
    """(activity, row number) -> (accepted, distinct slots taken before)."""
    parse = dt.datetime.fromisoformat
    events = [
        (r[0], parse(r[1]).date(), 0, parse(r[3]), i, parse(r[4]))
        for i, r in enumerate(flights)
        if not r[5] and r[3] is not None and r[4] is not None
    ]
    events += [(r[0], parse(r[1]).date(), 1, parse(r[1]), i, parse(r[2])) for i, r in enumerate(services)]
    taken: dict = {}
    decided = {}
    for reg, day, activity, began, i, ended in sorted(events):
        slots = taken.setdefault((reg, day), [])
        clash = [s for s in slots if began.hour < s[1] and s[0] < ended.hour]
        decided[(activity, i)] = (not clash, list(dict.fromkeys(slots)))
        if not clash:
            slots.append((began.hour, ended.hour))
    return decided
