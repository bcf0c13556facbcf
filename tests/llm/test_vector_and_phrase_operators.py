"""Pivot search, collocations and vector codes against plain versions of their contracts."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from cartwheel.llm import collocations, pivot_search, vector_codes
from cartwheel.llm.vectors import LIMIT, exact_dots


@pytest.fixture(scope="module")
def make_vectors(spark):
    """Rows (vec_id, embedding, label) with extra columns named like inner ones."""
    names = ("place", "x", "pivot", "_label", "code", "A.b")
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.FloatType())),
            T.StructField("label", T.IntegerType()),
            *(T.StructField(n, T.StringType()) for n in names),
        ]
    )
    return lambda rows: spark.createDataFrame([(*r, *names) for r in rows], schema)


def odd_vectors(n=120, width=16):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, width))
    rows = []
    for i in range(n):
        v = centres[i % 4] + 0.2 * rng.normal(size=width)
        rows.append((i, [float(f) for f in np.float32(v / np.linalg.norm(v))], i % 3 if i % 7 else None))
    same = rows[40][1]
    rows += [(1000 + i, same, 1) for i in range(60)]  # a third of the rows are one vector, queries among them
    rows += [(40, same, 1), (40, rows[3][1], None), (None, same, 2), (None, rows[5][1], 2), (-20, rows[8][1], 0)]
    nan, inf = float("nan"), float("inf")
    rows += [(2000, None, 1), (2020, [None, *same[1:]], 1), (2040, [nan, *same[1:]], 1), (2060, [-inf, *same[1:]], 1)]
    rows += [(2080, [], 3), (2081, same[:5], 3), (2100, [0.0] * width, 3), (2101, [3e30, *same[1:]], 3), (2120, [*same, 0.5], 3)]
    return rows


def whole(rows, factor):
    """(row number, vec_id, label, vector) of the rows that take part, padded to one width."""
    ok = [(i, r) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max((len(r[1]) for _, r in ok), default=0)

    def scaled(x):
        return max(-LIMIT, min(LIMIT, math.floor(float(np.float32(x)) * factor)))

    return [(i, r[0], r[2], [scaled(x) for x in r[1]] + [0] * (width - len(r[1]))) for i, r in ok]


# ------------------------------------------------------------------------------------------------ exact products
def test_products_of_limbs_are_exact():
    rng = random.Random(3)
    for depth, size in ((1, 1 << 31), (8, 1 << 25), (8, 1 << 29), (64, 1 << 27), (300, 1 << 20)):
        a, b = ([[rng.randint(-size, size) for _ in range(depth)] for _ in range(n)] for n in (7, 5))
        a[0], b[0], b[1] = [size] * depth, [size] * depth, [-size] * depth
        want = [[sum(x * y for x, y in zip(u, v, strict=True)) for v in b] for u in a]
        assert exact_dots(np.array(a), np.array(b)).tolist() == want
    assert exact_dots(np.zeros((2, 3), np.int64), np.zeros((4, 3), np.int64)).tolist() == [[0] * 4] * 2


# ------------------------------------------------------------------------------------------------ top-k search
def plain_search(rows, top):
    vectors, out = whole(rows, 64), []
    for i, q, _, x in vectors:
        if q is None or q % 20:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y, strict=True)), c is None, c or 0, j) for j, c, _, y in vectors if j != i]
        out += [(q, k + 1, None if n else c, -s) for k, (s, n, c, _) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_search_equals_brute_force(make_vectors, monkeypatch):
    rows = odd_vectors()
    docs = make_vectors(rows)
    for conf in (pivot_search.Search(top=20, block=7, batch=3, share=2), pivot_search.Search()):
        got = pivot_search.search(docs, conf)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert found(got) == plain_search(rows, conf.top)
    for sample in (1, 3):  # few pivots
        monkeypatch.setattr(pivot_search, "SAMPLE", sample)
        assert found(pivot_search.search(docs, pivot_search.Search(block=16, batch=8, share=1))) == plain_search(rows, 20)


def test_search_passes_over_far_annuli(spark, make_vectors, monkeypatch):
    """The bounds spare most products where the vectors lie in clusters."""
    from cartwheel.llm import common

    rng = np.random.default_rng(9)
    centres = 10 * rng.normal(size=(8, 12))
    rows = [(i, [float(x) for x in centres[i % 8] + 0.01 * rng.normal(size=12)], 0) for i in range(800)]
    kept = {}

    def stored(df, label):
        kept[label] = common.stored(df, label)
        return kept[label]

    monkeypatch.setattr(pivot_search, "stored", stored)
    got = pivot_search.search(make_vectors(rows), pivot_search.Search(block=30, batch=1, share=1000))
    assert found(got) == plain_search(rows, 20)
    annuli = kept["annuli"].where("kind = 1").collect()
    batches = kept["annuli"].where("kind = 0").collect()
    met = sum(b["from"][a.pivot] <= a.high and a.low <= b["to"][a.pivot] for a in annuli for b in batches)
    assert len(annuli) >= 30 and len(batches) >= 4
    assert met <= 0.3 * len(annuli) * len(batches)  # a batch of one cluster is sent little of the others
    assert "CartesianProduct" not in got._jdf.queryExecution().toString()


def test_search_of_few_rows(make_vectors):
    assert pivot_search.search(make_vectors([])).count() == 0
    assert pivot_search.search(make_vectors([(0, None, 1), (20, [None], 1)])).count() == 0
    assert pivot_search.search(make_vectors([(0, [1.0], 1)])).count() == 0
    assert found(pivot_search.search(make_vectors([(0, [1.0], 1), (3, [-0.01], 1)]))) == [(0, 1, 3, -64)]


# ------------------------------------------------------------------------------------------------ vector codes
def plain_codes(rows, parts=8, entries=16, rounds=6):
    vectors = whole(rows, 4096)
    width = max((len(v) for *_, v in vectors), default=0)
    depth = -(-width // parts)
    vectors = [(i, c, label, v + [0] * (depth * parts - width)) for i, c, label, v in vectors]
    cut = [[v[p * depth : (p + 1) * depth] for p in range(parts)] for *_, v in vectors]
    lengths = [len(r[1]) if r[1] is not None else 0 for r in rows]
    first = sorted(range(len(vectors)), key=lambda k: (vectors[k][1] is None, vectors[k][1] or 0, vectors[k][3][: lengths[vectors[k][0]]]))
    books = [[list(cut[k][p]) for k in first[:entries]] for p in range(parts)]

    def assigned(p):
        gap = [[(sum((a - b) ** 2 for a, b in zip(x[p], e, strict=True)), k) for k, e in enumerate(books[p])] for x in cut]
        return [min(g) for g in gap]

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for x, (_, k) in zip(cut, assigned(p), strict=True):
                members[k].append(x[p])
            for k, own in members.items():
                books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    last = [assigned(p) for p in range(parts)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(last[p][n][0] for p in range(parts)) for n in range(len(vectors))]
    by_label = Counter()
    for (_, _, label, _), e in zip(vectors, errors, strict=True):
        by_label[label] += e
    return sorted(
        (
            (c, "".join(f"{last[p][n][1]:02x}" for p in range(parts)), errors[n], by_label[label], digest)
            for n, (_, c, label, _) in enumerate(vectors)
        ),
        key=repr,
    )


@pytest.mark.parametrize("broadcast", [True, False])
def test_codes_equal_plain_version(make_vectors, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(vector_codes, "fits_broadcast", lambda df: False)
    rows = odd_vectors()
    got = vector_codes.compress(make_vectors(rows)).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert found(got) == plain_codes(rows)


def test_codes_of_few_rows(make_vectors):
    assert vector_codes.compress(make_vectors([])).count() == 0
    assert vector_codes.compress(make_vectors([(1, None, 1), (2, [float("nan")], 1)])).count() == 0
    for rows in ([(7, [0.5, -0.25], None)], [(2, [1.0] * 8, 1), (1, [1.0] * 8, 1), (1, [2.0] * 8, 2)], [(1, [], 1), (2, [], 1)]):
        got = vector_codes.compress(make_vectors(rows)).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
        want = plain_codes(rows)
        assert [r[:4] for r in found(got)] == [r[:4] for r in want]
        assert any(r[1] for r in rows) is False or found(got) == want


# ------------------------------------------------------------------------------------------------ collocations
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_collocations(rows, conf):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, conf.longest + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        often = {g: a for g, a in counts.items() if a >= conf.least and len(g) > 1}
        covered = set()
        for g, a in often.items():
            inner = {g[i:j] for i in range(len(g)) for j in range(i + 2, len(g) + 1) if j - i < len(g)}
            covered |= {x for x in inner if 100 * a >= conf.cover * counts[x]}
        ranked = []
        for g, a in often.items():
            if g not in covered:
                cuts = [(1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
                score, k = min(cuts)
                ranked.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (s, a, g, left, right) in enumerate(sorted(ranked)[: conf.top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def make_texts(spark):
    kinds = "doc_id long, text string, lang string, words string, phrase string, part int, own boolean, `a.b` int, f long"
    return lambda rows: spark.createDataFrame(
        [(i, t, lang, "w", "p", 1, True, 2, 3) for i, (lang, t) in enumerate(rows)], kinds
    )


def odd_texts():
    rng = random.Random(11)
    words = ["The", "the", "a", "b\x01", "b", "é", "Éa", "zß", "　x", "q\x00", "-", "new", "york"]
    rows = []
    for k in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", " ", ", ", "\n", "."]) for _ in range(rng.randrange(40)))
        rows.append((rng.choice(["en", "en", "en", "de", None, ""]), text))
    rows += [("en", "New York City Hall Park"), ("en", "new york city hall park!")] * 9
    rows += [("en", None), (None, None), ("fr", ""), ("fr", " .,;"), ("fr", "\u0085   nbsp"), ("de", "lone")]
    rows += [("en", "a a a a a a a a " * 40), ("de", "the new " * 300)]
    return rows


@pytest.mark.parametrize("range_rows", [50_000, 5])
def test_collocations_equal_plain_version(make_texts, monkeypatch, range_rows):
    monkeypatch.setattr(collocations, "RANGE_ROWS", range_rows)
    rows = odd_texts()
    for conf in (collocations.Mining(least=3, top=60), collocations.Mining(least=2, cover=70, longest=4)):
        got = collocations.mine(make_texts(rows), conf)
        assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, conf)


def test_a_full_sieve_changes_nothing(make_texts, monkeypatch):
    monkeypatch.setattr(collocations, "SIEVE_BITS", 1 << 15)
    rows = [(None, " ".join(str(i % 997 + j) for j in range(60))) for i in range(1200)]
    conf = collocations.Mining(least=2, top=500)
    assert sorted(tuple(r) for r in collocations.mine(make_texts(rows), conf).collect()) == plain_collocations(rows, conf)


def test_collocations_of_empty_tables(make_texts):
    assert collocations.mine(make_texts([])).count() == 0
    assert collocations.mine(make_texts([("en", None), (None, "few words"), ("de", "")])).count() == 0
