from datetime import date

from postings.operators import gate

PAGES = "run_date date, country string, role_query string, page int, n int, count_reported int"
EXPECTED = "run_date date, pair string"
STATES = "run_date date, pair string, status string, pages int, collected int, count_reported int, finished_at string"


def d(n):
    return date(2026, 9, n)


def state(day, pair, status, at="t1"):
    return (d(day), pair, status, 1, 1, 1, at)


def test_completeness_by_the_last_page(table, rows):
    def seen(country, *pages):
        return [(d(1), country, "q", page, n, count) for page, n, count in pages]

    pages = table(
        PAGES,
        *seen("reached", (1, 50, 100), (2, 50, 100)),
        *seen("one short", (1, 50, 101), (2, 50, 101)),
        *seen("short page", (1, 50, 500), (2, 49, 500)),
        *seen("tenth is last", *[(p, 50, 900) for p in range(1, 10)], (10, 3, 900)),
        *seen("empty", (1, 0, None)),
        *seen("count unknown", (1, 50, None)),
        *seen("at the cap", (1, 50, 9000), (150, 50, 9000)),
    )
    found = dict(rows(gate.pair_completeness(pages), "country", "status"))
    assert found == {
        "reached": "complete", "one short": "failed", "short page": "complete", "tenth is last": "complete",
        "empty": "complete", "count unknown": "failed", "at the cap": "truncated",
    }


def scenario(table):
    full = lambda day, pair="gb": (d(day), pair, "q", 1, 3, 3)
    pages = table(
        PAGES, *[full(n) for n in (1, 2, 3)],
        (d(4), "gb", "q", 2, 50, 100), (d(5), "gb", "q", 2, 50, 101),
        (d(6), "gb", "q", 1, 49, 500), (d(7), "gb", "q", 1, 50, 60),
    )
    expected = table(EXPECTED, *[(d(n), p) for n in (1, 2, 3) for p in ("gb/q", "de/q")])
    states = table(
        STATES,
        state(1, "gb/q", "complete"), state(1, "de/q", "failed", "t1"), state(1, "de/q", "complete", "t2"),
        state(2, "gb/q", "failed"),
        state(3, "gb/q", "truncated"), state(3, "de/q", "complete"),
    )
    return pages, expected, states


def test_day_problems(table, rows):
    found = rows(gate.day_problems(*scenario(table)))
    ledger, files = "status file", "raw files, no status file"
    assert found == sorted([
        (d(2), "gb/q", "failed", ledger), (d(2), "de/q", "not collected", ledger),
        (d(3), "gb/q", "truncated", ledger),
        (d(5), "gb/q", "incomplete by files", files), (d(7), "gb/q", "incomplete by files", files),
    ], key=repr)


def test_a_ledger_without_pairs_still_judges_its_day(table, rows):
    pages, _, states = scenario(table)
    nothing = table(EXPECTED)
    days = table("run_date date", (d(7),), (d(5),))
    found = gate.day_problems(pages, nothing, states, days)
    assert rows(found) == []


def test_gate_and_override(table, rows):
    pages, expected, states = scenario(table)
    problems = gate.day_problems(pages, expected, states)
    vacancies = table("run_date date, source_id string, source_file string", *[(d(n), f"i{n % 2}", "f") for n in range(1, 8)])
    assert [r[0] for r in rows(gate.admit(vacancies, problems), "run_date")] == [d(1), d(4), d(6)]
    assert gate.admit(vacancies, problems, allow_incomplete=True).count() == 7
    summary = gate.load_summary(gate.admit(vacancies, problems)).first()
    assert (summary.files, summary.rows, summary.ids, summary.days) == (1, 3, 2, [d(1), d(4), d(6)])


def test_ledger_operations(table, rows, spark):
    _, expected, states = scenario(table)
    assert rows(gate.state_of(states, "2026-09-01", "de", "q")) == [("complete",)]
    assert rows(gate.state_of(states, "2026-09-02", "de", "q")) == []
    more = table(EXPECTED, (d(1), "gb/q"), (d(1), "us/q"))
    assert gate.with_expected(expected, more).count() == 7
    again = gate.to_collect_again(expected, states)
    assert rows(again) == sorted([(d(2), "gb/q"), (d(2), "de/q"), (d(3), "gb/q")], key=repr)
    totals = dict(((r.run_date, r.status), r.pairs) for r in gate.run_totals(states).collect())
    assert totals == {(d(1), "complete"): 2, (d(2), "failed"): 1, (d(3), "truncated"): 1, (d(3), "complete"): 1}
    assert rows(gate.incomplete_pairs(states)) == [(d(2), "gb/q", "failed"), (d(3), "gb/q", "truncated")]


def test_pages_prove_pairs_the_ledger_does_not_know(table, rows):
    pages, expected, states = scenario(table)
    known = gate.with_states_from_pages(states, gate.pair_completeness(pages))
    assert (d(4), "gb/q", "complete") in rows(known, "run_date", "pair", "status")
    assert (d(2), "gb/q", "complete") not in rows(known, "run_date", "pair", "status")


def test_grid(spark, table):
    grid = gate.expected_grid(table("run_date date", (d(1),), (d(2),)))
    assert grid.count() == 2 * 6 * 5
    assert grid.select("pair").distinct().count() == 30
