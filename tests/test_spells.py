"""Spells by their closure rule: documented cases, the default rule, brute force."""

import random
from datetime import date, timedelta

import pytest

from postings.operators import presence, spells

SCHEMA = "source_id string, observed_on date, country_code string"
KEYS = ("source_id", "observed_on", "country_code")


def d(n):
    return date(2026, 9, 1) + timedelta(days=n - 1)


def found(table, rows, observed, **rule):
    df = table(SCHEMA, *[(i, d(n), c) for i, n, c in observed])
    return [(k, s, o.day, p.day, c and c.day) for k, s, o, p, c in rows(
        spells.spells(df, *KEYS, **rule), "source_id", "spell", "opened_on", "last_present_on", "closed_on")]


# an ad of a country that is not collected on day 2 and without it on day 3; a control in a covered country
LOST_IN_A_HOLE = [("A", 1, "gb"), ("G", 1, "gb"), ("G", 3, "gb"), ("B", 1, "de"), ("K", 1, "de"), ("K", 2, "de"), ("K", 3, "de")]


def test_a_closure_in_a_hole_is_lost_by_default_and_found_over_holes(table, rows):
    assert ("A", 1, 1, 1, None) in found(table, rows, LOST_IN_A_HOLE)
    over = found(table, rows, LOST_IN_A_HOLE, over_holes=True)
    assert ("A", 1, 1, 1, 3) in over and ("B", 1, 1, 1, 2) in over and ("G", 1, 1, 3, None) in over


# absent on day 2, back on day 3
BACK = [("C", 1, "de"), ("C", 3, "de"), ("K", 1, "de"), ("K", 2, "de"), ("K", 3, "de"), ("K", 4, "de"), ("K", 5, "de")]


def test_an_ad_that_returns_opens_a_new_spell_unless_the_rule_waits(table, rows):
    assert [s for s in found(table, rows, BACK) if s[0] == "C"] == [("C", 1, 1, 1, 2), ("C", 2, 3, 3, 4)]
    assert [s for s in found(table, rows, BACK, absent_days=2) if s[0] == "C"] == [("C", 1, 1, 3, 5)]
    assert [s for s in found(table, rows, BACK, absent_days=3) if s[0] == "C"] == [("C", 1, 1, 3, None)]


def brute(observed, absent_days, over_holes):
    days = sorted({n for _, n, _ in observed})
    covered = {(n, c) for _, n, c in observed}
    out = []
    for key in sorted({k for k, *_ in observed}):
        mine = sorted((n, c) for k, n, c in observed if k == key)
        spell = [1, mine[0][0]]
        for at, (n, c) in enumerate(mine):
            absent, closed = 0, None
            for later in [x for x in days if x > n]:
                if at + 1 < len(mine) and later >= mine[at + 1][0]:
                    break
                if (later, c) in covered:
                    absent += 1
                elif not over_holes:
                    break
                if absent == absent_days:
                    closed = later
                    break
            if closed or at + 1 == len(mine):
                out.append((key, spell[0], spell[1], n, closed))
                if at + 1 < len(mine):
                    spell = [spell[0] + 1, mine[at + 1][0]]
    return out


@pytest.mark.parametrize("absent_days", [1, 2, 3])
@pytest.mark.parametrize("over_holes", [False, True])
def test_spells_by_brute_force(table, rows, absent_days, over_holes):
    draw = random.Random(10 * absent_days + over_holes)
    holes = {(n, c) for n in range(1, 16) for c in ("gb", "de") if draw.random() < 0.2}
    observed = [(f"i{k}", n, c) for k in range(25) for n in range(1, 16) if n != 7 and (n, c := draw.choice(["gb", "de"]) if k % 8 == 0 else ("gb", "de")[k % 2]) not in holes and draw.random() < 0.5]
    assert found(table, rows, observed, absent_days=absent_days, over_holes=over_holes) == brute(observed, absent_days, over_holes)


def test_the_default_rule_closes_where_rows_are_gone(table, rows):
    draw = random.Random(2)
    observed = [(f"i{k}", n, ("gb", "de", "us")[k % 3]) for k in range(30) for n in range(1, 13) if (n + k % 3) % 5 and draw.random() < 0.6]
    df = table(SCHEMA, *[(i, d(n), c) for i, n, c in observed])
    closed = spells.spells(df, *KEYS).where("closed_on IS NOT NULL")
    gone = presence.gone_rows(df, *KEYS)
    assert rows(closed, "source_id", "closed_on", "last_present_on") == rows(gone, "source_id", "observed_on", "last_present_on")
