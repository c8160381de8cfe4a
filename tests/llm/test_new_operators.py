"""The divergence audit, conversation repair and Hamming join against brute force, SQL twins and rows chosen to break them."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("postings.llm")
from postings.llm import conversation_repair, hamming_join, queries, source_divergence
from postings.llm.conversation_repair import Audits, Repair
from verification.compare import connect, normal

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{k % 977} {k}" for k in range(20_000))
WORD = r"[^\x20\x09-\x0D]+"
ODD = "doc_id long, text string, lang string, source string, term string, count long, value long, rank int, node string, key string, kept string"
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", "en", None), (4, "one two", None, "a"), (5, "one two", "en", "b"),
    (6, LONG, "en", "a"), (7, LONG + " end", "en", "a"), (8, "É é İ a b don't x1y", "en", "b"), (9, "a b c d e f", "en", "c"), (10, "A B C d e F", "en", "c"),
    (11, "a b c d e g", "en", "c"), (12, "word " * 30, "en", "d"), (13, "word " * 30, "en", "d"), (13, "word " * 30, "en", "d"), (None, "word " * 30, "en", "d"),
    (None, "nameless row", "fr", "b"), (None, "nameless row", "fr", "b"), (14, "other", "de", ""), (15, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "t", 7, 8, 9, "n", "k", "no") for r in ROWS], ODD).repartition(3)


@pytest.mark.parametrize("name", ["op11_source_divergence", "op13_hamming_join"])
def test_sql_twins(spark, name):
    assert normal(queries.QUERIES[name](spark, SF).toPandas()) == normal(connect(SF).execute(queries.ORACLE[name]).df())


# --- 11: divergence ---------------------------------------------------------------------------------

def brute_divergence(rows, least, top):
    rows = [tuple("" if c is None else c for c in r) for r in rows]
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(lower)) for t, _, _ in rows]
    out = set()
    for lang in {r[1] for r in rows}:
        mine = [(t, r[2]) for t, r in zip(terms, rows) if r[1] == lang]
        kept = sorted({w for t, _ in mine for w in t if sum(w in u for u, _ in mine) >= least})

        def shares(chosen):
            count = {w: sum(t.count(w) for t in chosen) for w in kept}
            whole = sum(count.values()) + 2 * len(kept)
            return count, {w: 1 + 10**9 * (count[w] + 2) // whole for w in kept}

        _, q = shares([t for t, _ in mine])
        groups = {s: shares([t for t, o in mine if o == s]) for s in {s for _, s in mine}}
        for s, (count, p) in groups.items():
            pair = [(sum((p[w] - o[w]) ** 2 // (p[w] + o[w]) for w in kept), other) for other, (_, o) in groups.items() if other != s]
            term = [((p[w] - q[w]) ** 2 // (p[w] + q[w]), w) for w in kept if count[w] and p[w] > q[w]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                for k, (value, item) in enumerate(sorted(found, key=lambda f: (-f[0], f[1].encode()))[:most]):
                    out.add((lang, s, part, item, value, k + 1))
    return out


@pytest.mark.parametrize("least, top", [(10, 10), (2, 3), (1, 10)])
def test_divergence_by_brute_force(odd, least, top):
    found = source_divergence.audit(odd, least, top)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in found.collect()} == brute_divergence([r[1:4] for r in ROWS], least, top)


def test_divergence_hands_on_in_parts(odd, monkeypatch):
    """Tasks run in processes of their own, so the parts are driven here: tiny windows and flushes give the same counts."""
    rows = [("" if t is None else t, lang or "", source or "") for _, t, lang, source in ROWS]
    batches = [pa.RecordBatch.from_arrays([pa.array([c]) for c in (lang, source, text)], ["lang", "source", "text"]) for text, lang, source in rows]

    def counts():
        folded = sorted((r for b in source_divergence._folded(iter(batches)) for r in b.to_pylist()), key=lambda r: (r["lang"], r["digest"], r["text"] is None))
        again = [pa.RecordBatch.from_pylist([r], pa.schema([("lang", pa.string()), ("digest", pa.binary()), ("source", pa.string()), ("n", pa.int64()), ("text", pa.string())])) for r in folded]
        total = {}
        for b in source_divergence._counted(iter(again)):
            for r in b.to_pylist():
                key = (r["lang"], r["source"], r["term"])
                total[key] = tuple(x + y for x, y in zip(total.get(key, (0, 0)), (r["count"], r["docs"])))
        return total

    whole = counts()
    monkeypatch.setattr(source_divergence, "WINDOW_BYTES", 1)
    monkeypatch.setattr(source_divergence, "FLUSH", 3)
    assert counts() == whole and whole["en", "d", "word"] == (120, 4)


# --- 12: conversations -------------------------------------------------------------------------------

STEP = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
NAME = {"u": "user", "a": "assistant"}


def cheapest(turns):
    """(cost, audit, repaired turns), with whole audits as strings."""
    def inserted(best):
        changed = True
        while changed:
            changed = False
            for state, (cost, audit, out) in list(best.items()):
                for role in NAME:
                    to, way = STEP[state].get(role), (cost + 5, audit + "I", (*out, (NAME[role], "")))
                    if to and (to not in best or way[:2] < best[to][:2]):
                        best[to], changed = way, True
        return best

    best = inserted({"": (0, "", ())})
    for role, text, fault in turns:
        ways = []
        for state, (cost, audit, out) in best.items():
            ways.append((cost + 2, audit + "D", out, state))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            if to := STEP[state].get(role[:1]):
                ways.append((cost + more, audit + "K", (*out, (role, text)), to))
            ways += [(cost + more + 1, audit + "R", (*out, (NAME[r], text)), to) for r, to in STEP[state].items() if r in NAME]
        best = inserted({to: min((w[:3] for w in ways if w[3] == to), key=lambda w: w[:2]) for to in {w[3] for w in ways}})
    return min((best[s] for s in ("", "a") if s in best), key=lambda w: w[:2])


@pytest.mark.parametrize("nodes", [4, 40, 20_000])
@pytest.mark.parametrize("base", [1_000_003, 1, 0])
def test_audits_by_brute_force(monkeypatch, nodes, base):
    """Also when prefixes are written off all the time, and when hashes collide."""
    monkeypatch.setattr(conversation_repair, "NODES", nodes)
    draw = random.Random(nodes + base)
    for _ in range(400):
        roles = draw.choice([["user", "assistant", "system", "tool", "uncle", "", " "], ["user", "assistant"], ["user"], ["system", "assistant"]])
        faults = draw.choice([[None], [None, "truncated"], [None, None, "blank", "duplicate", "truncated"]])
        turns = [(draw.choice(roles), "t", draw.choice(faults)) for _ in range(draw.choice([0, 1, 2, 3, 5, 9, 40]))]
        repair = Repair(Audits(base))
        for role, _, fault in turns:
            repair.turn(role[:1], fault)
        assert repair.result() == cheapest(turns)[:2], turns


def test_a_long_conversation_is_written_off():
    repair = Repair()
    for k in range(50_000):
        repair.turn("ua"[k % 2], None)
    assert repair.result() == (0, "K" * 50_000)
    assert len(repair.audits.edit) <= conversation_repair.NODES + 10


def brute_repair(rows):
    convs = {}
    for conv, turn, role, text in rows:
        turns = convs.setdefault(conv, [])
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        hit = zlib.crc32(key.encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        turns += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    out = set()
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        numbers = {t for t, _, _ in turns if t is not None}
        seen, found, legal = set(), [], {"su", "ua", "au"}
        for _, role, text in turns:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            found.append("blank" if not last else "duplicate" if (role, text) in seen else None if last[0] in ".!?" else "truncated")
            seen.add((role, text))
        cost, audit, left = cheapest([(role, text, f) for (_, role, text), f in zip(turns, found)])
        illegal = sum(a[1][:1] + b[1][:1] not in legal for a, b in zip(turns, turns[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        out.add((conv, gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return out


def test_conversations_by_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert {tuple(r) for r in queries.QUERIES["op12_conversation_repair"](spark, SF).collect()} == brute_repair([tuple(r) for r in rows])


def test_odd_conversations(spark):
    draw = random.Random(3)
    texts = [None, "", " \t", "Yes.", "No!\n", "cut", "é?", " ", "a.b", "end. \x0b", LONG]
    rows = [(draw.choice([None, 1, 2, 3, 4, 5]), draw.choice([None, -3, 0, 1, 2, 9]), draw.choice([None, "", "user", "assistant", "system", "tool"]), draw.choice(texts)) for _ in range(120)]
    rows += [(k, 0, "user", "only.") for k in range(100, 160)] + [(9, 1, "user", "Same.")] * 5
    wide = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, part int, audit string, other string").repartition(4)
    assert {tuple(r) for r in conversation_repair.report(wide).collect()} == brute_repair(rows)
    assert conversation_repair.report(wide.where("false")).collect() == []


def test_repaired_turns(table, spark):
    rows = conversation_repair.turns(table("conv_id long, turn long, role string, text string", (1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", None)))
    found = conversation_repair.audits(rows)
    assert [tuple(r) for r in found.collect()] == [(1, 0, 1, 0, 0, 1, 3, "RKD")]
    kept = sorted(tuple(r) for r in conversation_repair.repaired(rows, found).collect())
    assert kept == [(1, 0, "R", "user", "Be kind."), (1, 1, "K", "assistant", "Hello.")]


# --- 13: Hamming join ----------------------------------------------------------------------------------

def linked(rows, share=85):
    sets = []
    for _, text in rows:
        words = re.findall(WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(words[k:k + 5]) for k in range(max(len(words) - 4, 1))} if words else set())
    head = list(range(len(rows)))

    def root(k):
        while head[k] != k:
            k = head[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= share * (len(sets[i]) + len(sets[j]) - both):
                head[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if root(k) == root(i) and rows[k][0] is not None]
        least = min(ids, default=None)
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=repr)


def test_hamming_join_on_odd_rows(odd):
    found = hamming_join.join(odd)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == linked([r[:2] for r in ROWS])
    assert hamming_join.join(odd.where("false")).collect() == []


def test_hamming_join_on_chains_around_the_threshold(spark):
    """Families of texts at every similarity around 0.85, which link directly, over others, or not at all."""
    draw = random.Random(11)
    rows = []
    for family in range(12):
        base = [f"w{family}x{k}" for k in range(draw.choice([8, 30, 120, 400]))]
        for _ in range(40):
            text = list(base)
            for _ in range(draw.randrange(0, max(2, len(base) // 40))):
                text[draw.randrange(len(text))] = f"new{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
            if draw.random() < 0.3:
                base = text
    found = hamming_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == linked(rows)


def test_signatures_within_the_distance_share_a_key():
    draw = np.random.default_rng(1)
    left = draw.integers(0, 1 << 16, (300, hamming_join.PLACES), dtype=np.uint16)
    right = left.copy()
    for k, row in enumerate(right):
        row[draw.choice(hamming_join.PLACES, hamming_join.DISTANCE, replace=False)] ^= np.uint16(1 + k)
    a, b = hamming_join.keys(left), hamming_join.keys(right)
    assert (a == b).any(1).all()
    assert not (hamming_join.keys(left[:-1]) == hamming_join.keys(left[1:])).any()


# --- shared parts and the pipeline ------------------------------------------------------------------------

CLASHING = ["group", "_one", "_lines", "_spans", "_size", "_row", "_copy", "_taken", "_kept", "_head", "_linked", "_empty", "kept", "node", "t", "size"]


def test_stages_carry_any_column_along(spark):
    """Columns of whatever name come through every stage with their values, and decide nothing."""
    import corpus_pipeline
    text = " ".join(f"word{k % 50} and{k}" for k in range(120))
    rows = [(k, f"{text} {k} {'x' * (k % 7)}", "en", f"s{k % 3}", 1) for k in range(60)] + [(99, None, None, None, None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = sorted((tuple(r) for r in stage(spark, plain, SF).collect()), key=repr)
        wide = plain.select("*", *[plain.doc_id.cast("string").alias(c) for c in CLASHING])
        found = stage(spark, wide, SF)
        assert found.columns == wide.columns, name
        assert sorted((tuple(r[:5]) for r in found.collect()), key=repr) == kept, name
        assert all(r[c] == (None if r.doc_id is None else str(r.doc_id)) for r in found.collect() for c in CLASHING), name


def test_later_stages_drop_what_earlier_ones_wrote(spark, monkeypatch):
    import corpus_pipeline
    from postings.sources import warehouse
    dropped = []
    delete = warehouse._delete
    monkeypatch.setattr(warehouse, "_delete", lambda s, path: dropped.append(path) or delete(s, path))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = corpus_pipeline.rules(spark, docs, SF)
    written = warehouse.stored(judged)
    lazy = corpus_pipeline.mixture(spark, judged, SF)  # reads what the first stage wrote
    assert not dropped and lazy.count() > 0
    corpus_pipeline.mixture(spark, written, SF)
    assert dropped and written.count() > 0


def test_training_rows_are_bounded_by_the_sample(spark):
    from postings.llm import labelled
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(50)] + [(k, f"other {k}") for k in range(2, 40)] + [(2, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(k, k % 2) for k in range(1, 40)] * 3 + [(None, 1), (3, None)], "doc_id long, quality int")
    for most in (1, 5, 1000):
        rows = labelled.training_rows(docs, marks, "quality", most).collect()
        assert len(rows) == len({r.doc_id for r in rows}) <= most
    assert {r.text for r in rows if r.doc_id == 1} <= {"text 0"} and {r.text for r in rows if r.doc_id == 2} <= {"other 2"}


def test_training_and_scores_by_a_plain_learner():
    """Follow-the-regularised-leader one feature at a time in dictionaries, on the operator's own features."""
    from postings.llm import quality_classifier as q
    from postings.llm.text import slices
    draw = random.Random(8)
    texts = [" ".join(draw.choice("good fine text bad junk !!! x1".split()) for _ in range(draw.randrange(0, 30))) for _ in range(40)] + ["", None]
    labels = np.array([draw.randrange(2) for _ in texts])
    bits, alpha, beta, l1, l2 = 10, 0.6, 1.0, 0.002, 0.001
    found = []
    for _, data, offsets in slices(pa.array(texts, pa.string())):
        row, bucket, value = q.features(data, offsets, bits)
        for r in range(len(offsets) - 1):
            held = {}
            for k in np.flatnonzero(row == r):
                held[int(bucket[k])] = held.get(int(bucket[k]), 0.0) + float(value[k])
            found.append({**{i: float(np.float32(v)) for i, v in held.items()}, 1 << bits: 1.0})
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)

    for epoch in range(3):
        for k in np.random.default_rng(epoch).permutation(len(found)):
            share = 1 / (1 + np.exp(-np.clip(sum(weight(i) * v for i, v in found[k].items()), -30, 30)))
            for i, v in found[k].items():
                g, before = (share - labels[k]) * v, n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (np.sqrt(before + g * g) - np.sqrt(before)) / alpha * weight(i)
                n[i] = before + g * g
    weights = q.train(pa.array(texts, pa.string()), labels, bits)
    assert np.allclose(weights, [weight(i) for i in range((1 << bits) + 1)], atol=1e-4)
    expected = [1 / (1 + np.exp(-np.clip(sum(weights[i] * v for i, v in f.items()), -30, 30))) for f in found]
    assert np.allclose(q.scores(pa.array(texts, pa.string()), weights), expected, atol=1e-6)
