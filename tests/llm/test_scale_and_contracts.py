"""Hot keys, blocks, clashing names and brute-force versions of the training-data operators."""

import base64
import hashlib
import itertools
import math
import random
import string
import zlib

import numpy as np
import pytest
from prose_llm import prose
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_llm_operators import SPACE, plain_components, plain_hits, shingle_set

from cartwheel.llm import (
    common,
    decontamination,
    language_id,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    token_counts,
    token_files,
    warc,
)


# ------------------------------------------------------------------------------------------------- pipeline
NAMES = ("_id", "_raw", "_place", "_doc", "row", "id", "raw", "linked", "_text", "_words", "_chunk", "a.b", "text.x", "`q`")


@pytest.fixture(scope="module")
def clashing(spark):
    """Documents with columns named like inner ones, with dots, and a struct with a ``text`` of its own."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
            *(T.StructField(n, T.StringType()) for n in NAMES),
            T.StructField("a", T.StructType([T.StructField("b", T.LongType()), T.StructField("text", T.StringType())])),
        ]
    )

    def make(rows):
        extra = [f"{n} of" for n in NAMES]
        full = [(i, t, "en", "s", len(t) if t is not None else None, *[f"{e} {i}" for e in extra], (i, "inner")) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


def test_stages_keep_every_column(spark, clashing):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 80").first().text
    base = prose(80, 1)
    secret = prose(30, 2) + " password=abcdefgh12345678 " + prose(30, 3)
    rows = [(1, base), (2, base.title()), (2, base), (3, secret), (4, prose(40, 4) + " " + item), (5, "few words"), (6, None), (7, ""), (None, prose(60, 5))]
    docs = clashing(rows)
    want = {"quality_rules": [1, 2, 2, 3, 4, None], "near_dedup": [1, 3, 4, None], "decontamination": [1, 3, None], "secret_scan": [1, 3, None]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        out = common.stored(stage(spark, docs, sf), name)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        after = out.collect()
        assert sorted((r.doc_id for r in after), key=lambda i: (i is None, i or 0)) == want[name], name
        for r in after:
            changed = {"text", "n_chars"} if name == "secret_scan" and r.doc_id == 3 else set()
            if list(before).count(r.doc_id) == 1 and r.doc_id != 2:
                assert all(r[c] == before[r.doc_id][c] for c in docs.columns if c not in changed)
        docs = out
    assert {r.doc_id for r in corpus_pipeline.pack_by_length(spark, docs, sf).collect()} == {1, 3, None}
    empty = clashing([])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, sf)
        assert out.count() == 0 and (name == "packing" or out.columns == empty.columns)


def test_scratch_folders_are_removed_by_their_owner(spark, clashing):
    from pathlib import Path

    def place(folder):
        return Path(folder.removeprefix("file:"))

    with common.scratch(spark) as folder:
        kept = near_dedup.near_duplicates(clashing([(1, prose(20, 1)), (2, prose(20, 1))])).collect()
        assert len(kept) == 2 and any(place(folder).iterdir())
    assert not place(folder).exists()
    assert not common.shared_folder(spark, "x").startswith(folder)


def test_empty_tables_of_single_operators(spark, clashing):
    import public_tokenizers

    empty = clashing([])
    assert quality_rules.judged(empty).count() == 0
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert token_counts.with_token_counts(empty, path).count() == 0
    net = quality_classifier.learn(empty, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality_classifier.scored(empty, net).count() == 0
    assert language_id.identify(empty, language_id.learn(empty)).count() == 0


def test_policies_are_named_and_apply_to_a_stored_ledger(clashing):
    rows = common.stored(quality_rules.ledger(clashing([(1, "few words"), (2, prose(60, 1)), (3, "A B " * 40)])), "ledger")
    strict = quality_rules.Policy("strict", 7, quality_rules.BASE.rules)
    for policy in (quality_rules.WEB, strict):
        got = {r.doc_id: r for r in quality_rules.verdicts(rows, policy).collect()}
        assert {(r.policy, r.version) for r in got.values()} == {(policy.name, policy.version)}
        assert {i: r.kept for i, r in got.items()} == {
            i: not r.failures & policy.mask and not r.base_failed for i, r in got.items()
        }


# ----------------------------------------------------------------------------------------------- near-dedup
def test_one_band_on_a_third_of_all_rows(spark, clashing, monkeypatch):
    """Near copies of one page share bands; leaders and blocks are parted, and results stay those of brute force."""
    monkeypatch.setattr(near_dedup, "STAR", 4)
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    base = prose(150, 40).split()
    rows = []
    for k in range(45):  # 30 that differ from the base in a place, and 15 that drift from each other
        words = list(base)
        words[3 * k % 150] = f"own{k}"
        if k >= 30:
            words[:] = [f"v{k // 5}x{i}" if i % 13 == 0 else w for i, w in enumerate(words)]
        rows.append((k, " ".join(words)))
    rows += [(100 + k, prose(60, 60 + k)) for k in range(60)]
    for percent, conf in ((85, near_dedup.NearDup(85, 26, 5)), (80, near_dedup.NearDup(80, 200, 2))):
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(clashing(rows), conf).collect()}
        assert got == plain_components(rows, percent)


def test_rarest_shingles_miss_no_link():
    import pyarrow as pa

    pick = random.Random(8)
    for percent in (60, 80, 85):
        pool = [[*range(0, 40), *pick.sample(range(100, 140), 8)] for _ in range(10)]
        sets = [sorted(set(pick.choice(pool)) ^ set(pick.sample(range(50), pick.randrange(9)))) for _ in range(60)]
        cells = {
            "id": pa.array(range(60), pa.int64()),
            "component": pa.array(range(60), pa.int64()),
            "is_outer": pa.array([k % 2 == 0 for k in range(60)]),
            "shingles": pa.array(sets, pa.list_(pa.int64())),
        }
        got = near_dedup._block_links(percent)(pa.table(cells)).to_pylist()
        want = {
            (a, b)
            for a, b in itertools.product(range(0, 60, 2), range(1, 60, 2))
            if 100 * len({*sets[a]} & {*sets[b]}) >= percent * len({*sets[a]} | {*sets[b]})
        }

        def joined(links):
            up = list(range(60))

            def top(x):
                while up[x] != x:
                    x = up[x]
                return x

            for a, b in links:
                up[max(top(a), top(b))] = min(top(a), top(b))
            return [top(x) for x in range(60)]

        links = {(r["a"], r["b"]) for r in got}
        assert joined(links) == joined(want) and len(links) == 60 - len(set(joined(want)))


# ------------------------------------------------------------------------------------------ decontamination
def test_blocks_of_items_find_the_same(spark, clashing, monkeypatch):
    items = [(i, prose(n, 500 + n)) for i, n in enumerate([*range(1, 40), 100, 300, 700])] + [(90, "word " * 2000)]
    pick = random.Random(4)
    docs = []
    for k in range(60):
        words = pick.choice(items)[1].split()
        at = pick.randrange(len(words) + 1)
        words[at:at] = prose(pick.randrange(1, 60), 40 + k).split()
        docs.append((k, prose(pick.randrange(1, 300), 9 + k) + " " + " ".join(words) + " " + prose(40, 70 + k)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {(d, items[i][0]) for d, i in plain_hits([t for _, t in docs], [t for _, t in items])}
    for size in (decontamination.BLOCK_BYTES, 800):
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", size)
        assert len(decontamination.item_blocks(bench)) == 1 if size > 800 else len(decontamination.item_blocks(bench)) > 3
        got = decontamination.find(clashing(docs), bench)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == want
        kept = {r.doc_id for r in decontamination.clean(clashing(docs), bench).collect()}
        assert kept == {i for i, _ in docs} - {i for i, _ in want}


def test_sketches_find_contained_items_with_the_stated_chance():
    """Recall at exactly 80 percent containment, sizes 17 to 700 shingles, against the exact definition."""
    rng, found, tried = np.random.default_rng(2), 0, 0
    for n in [*range(17, 60), 100, 200, 400, 700]:
        for _ in range(8):
            index = decontamination.ItemIndex()
            words = rng.integers(0, 2**63, n + 4, dtype=np.uint64)
            own = np.unique(decontamination.shingle_hashes(words))
            index.names, index.sets, index.widths = ["x"], [own], [5]
            index.prepare()
            # the first four fifths of the item's shingles, and others
            part = -(-80 * len(own) // 100)
            doc = np.concatenate([words[: part + 4], rng.integers(0, 2**63, 3000, dtype=np.uint64)])
            tried += 1
            found += 0 in index.search(doc)
            assert 0 not in index.search(np.concatenate([words[: part + 3], doc[part + 4 :]]))
    assert found >= 0.99 * tried
    assert decontamination.size_class(1) == 1 and decontamination.size_class(17) == 32
    known = index.lookups[5, decontamination.size_class(len(own))]
    assert known.starts[-1] == decontamination.HASHES


# ---------------------------------------------------------------------------------------------- token files
def test_token_files_with_hot_ids_over_many_files(spark, clashing, tmp_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(7, prose(12, k % 3)) for k in range(40)] + [(None, prose(9, 50 + k)) for k in range(40)]
    rows += [(k, prose(5, 100 + k)) for k in range(40)] + [(7, None), (8, "")]
    written = token_files.write(clashing(rows), path, 2, f"{tmp_dir}/files", partitions=6, roll_docs=5)
    listed = written.files.collect()
    assert max(f.n_docs for f in listed) <= 5 and len({f.number >> 32 for f in listed}) >= 5
    got = sorted((tuple(r) for r in token_files.read(spark, written).collect()), key=lambda r: r[1])
    library = Tokenizer.from_file(path)

    def crc(text):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())

    assert sorted(map(repr, ((i, *crc(t)) for i, t in rows))) == sorted(map(repr, ((i, n, c) for i, _, n, c in got)))
    ids = [i for i, *_ in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [s for _, s, _, _ in got] == [0, *itertools.accumulate(n for _, _, n, _ in got)][:-1]


# -------------------------------------------------------------------------------------------------- packing
def test_packing_parts_null_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 50)
    seen = {}
    real = packing.stored
    monkeypatch.setattr(packing, "stored", lambda df, label: seen.setdefault(label, real(df, label)))
    rows = [(None, 60)] * 400 + [(5, 60)] * 400 + [(10 + i, 60) for i in range(400)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, n_tokens long"), packing.Packing(64, 2, 640))
    assert got.columns == ["doc_id", "segment", "start", "length", "bucket_length", "batch", "place"]
    places = [(r.batch, r.place) for r in got.collect()]
    assert len(set(places)) == len(places) == 1200 and max(b for b, _ in places) == -(-1200 // 10) - 1
    chunks = 1 + 1200 // 50
    sizes = [r["count"] for r in seen["segments"].groupBy(F.pmod(F.xxhash64("_row"), F.lit(chunks))).count().collect()]
    assert len(sizes) == chunks and max(sizes) <= 5 * np.median(sizes)


# ----------------------------------------------------------------------------------------------------- WARC
def test_warc_with_one_payload_on_a_third_of_the_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "ROWS", 7)
    hot, twice = "<p>" + "hot " * 60, "<p>" + "é" * 90
    rows = [(k, None, hot) for k in range(120)] + [(k, "u", "") for k in range(200, 260)] + [(None, "u", hot)] * 40
    rows += [(500 + k, f"http://x/{k}", f"{k} " * 90) for k in range(100)] + [(700, "u", twice), (701, "u", twice), (701, "v", twice)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'x' as payload", "1 as first_id", "'y' as `a.b`")
    files = warc.write(pages, roll_bytes=3000)
    listed = files.collect()
    assert len(listed) > 8 and sum(f.n_records for f in listed) == len(rows)
    got = sorted(tuple(r) for r in warc.read(spark, files).na.fill(-1).collect())
    first = {}
    for i, _, t in rows:
        if i is not None and len(t.encode()) >= 100:
            first[t] = min(i, first.get(t, i))
    want = []
    for i, _, t in rows:
        again = i is not None and i > first.get(t, i)
        data = t.encode()
        want.append((-1 if i is None else i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[t] if again else -1))
    assert got == sorted(want)


# ---------------------------------------------------------------------------------------------- language id
def test_what_a_letter_is():
    import regex

    for text in ("½ ²", "Ⅷ", "１２", "ª", "ʰ", "́", "漢", "ß", "_", "٣", "1a", "", "🄰", "ǅ"):
        assert language_id.has_letter(text) == bool(regex.search(r"\p{L}", text)), text
    assert not language_id.has_letter(None)
    classify = language_id.Classifier({"en": b"some words"}).classify
    assert classify("½ ²")[0] == "und" and classify("½ a")[0] == "en"


def test_classify_equals_a_plain_loop():
    import zstandard

    learned = {k: language_id.letters(prose(900, s).translate(str.maketrans("aeiou", v))) for k, s, v in (("a", 1, "aeiou"), ("b", 2, "éèíóú"), ("c", 3, "uoiea"))}
    classify = language_id.Classifier(learned).classify
    for k in range(30):
        text = prose(5 + 60 * k, 100 + k).translate(str.maketrans("aeiou", ("aeiou", "éèíóú", "uoiea")[k % 3]))
        data = b" ".join(bytes(b if chr(b).isalpha() or b > 127 else 32 for b in text.lower().encode()).split())
        sizes = {}
        for name, content in learned.items():
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            press = zstandard.ZstdCompressor(level=6, dict_data=dictionary, write_checksum=False, write_content_size=False)
            sizes[name] = sum(len(press.compress(data[i : i + 4096])) for i in range(0, len(data), 4096))
        (best, name), (second, _) = sorted((n, name) for name, n in sizes.items())[:2]
        got = classify(text)
        assert got[0] == name == "abc"[k % 3]
        assert got[1] == pytest.approx(second / (best + second)) and got[2] == pytest.approx((second - best) / second)


def test_many_languages_share_the_room(spark, monkeypatch):
    rows = [(prose(400, k % 50), f"l{k:03d}") for k in range(250)] + [("only once", "rare")]
    table = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(language_id, "ALL_DICTIONARIES", 250 * 1024)
    learned = language_id.learn(table)
    assert len(learned) == 251 and max(map(len, learned.values())) <= 250 * 1024 // 251
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 250)
    assert set(language_id.learn(table)) == set(learned) - {"rare"}


def test_every_piece_of_a_text_can_be_learned_and_copies_count_once(spark):
    parts = [f"{w} " * 300 for w in ("alpha", "bravo", "candy", "delta", "eagle")]
    rows = [("".join(parts), "x")] * 50 + [("other words here", "x"), (None, "x"), ("", "x"), ("½", "y")]
    learned = language_id.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert all(w.encode() in learned["x"] for w in ("alpha", "bravo", "candy", "delta", "eagle", "other"))
    assert len(learned["x"]) < 3 * len("".join(parts))


# ---------------------------------------------------------------------------------------------- secret scan
OTHER_WORDS = (
    "garden violin harbour lantern compass meadow thunder whisper castle orchard ribbon marble feather puzzle shadow velvet "
    "breakfast notebook keyboard window engine bridge signal pocket summer winter river island button ladder mirror "
    "abfahrt zeitung fenster schule bahnhof fromage voiture chanson fenetre camino ventana mercado escuela widget parser token"
).split()


def held_out_string(pick, length):
    """Structured strings of other words and rules than those that the thresholds come from."""
    words = [pick.choice(OTHER_WORDS) for _ in range(length // 3 + 2)]
    style = pick.randrange(6)
    if style == 0:
        text = "-".join(words)
    elif style == 1:
        text = "/" + "/".join(f"{w}_{v}" if pick.random() < 0.3 else w for w, v in zip(words, words[1:], strict=False))
    elif style == 2:
        text = words[0] + "".join(w.title() for w in words[1:])
    elif style == 3:
        text = f"{pick.randrange(2000, 2030)}-{pick.randrange(1, 13):02d}-" + "-".join(words)
    elif style == 4:
        text = "_".join(words).upper()
    else:
        text = "".join(w.title() + (str(pick.randrange(99)) if pick.random() < 0.2 else "") for w in words)
    return text[:length]


def key(pick, length):
    kind = pick.randrange(3)
    if kind == 0:
        return base64.b64encode(pick.randbytes(length)).decode()[:length]
    if kind == 1:
        return base64.urlsafe_b64encode(pick.randbytes(length)).decode()[:length]
    return "".join(pick.choice(string.ascii_letters + string.digits) for _ in range(length))


def test_false_discoveries_are_held_in_every_length_class(clashing):
    """One key for 15 structured strings in each class: at most 1 percent of the spans are wrong, 0.9 of the keys found."""
    pick = random.Random(12)
    rows, made = [], {}
    ends = [*secret_scan.LENGTHS[1:], 250]
    for k, (low, high) in enumerate(zip(secret_scan.LENGTHS, ends, strict=True)):
        for j in range(1600):
            length, is_key = pick.randrange(low, high), j % 16 == 0
            text = (key if is_key else held_out_string)(pick, length)
            made[len(rows)] = (k, is_key)
            rows.append((len(rows), f"see {text} there"))
    docs = clashing(rows)
    least = secret_scan.fit(docs)
    found = {r.doc_id for r in secret_scan.scan(docs, least).where("spans like '%random:%'").collect()}
    for k in range(len(ends)):
        keys, others = ([i for i, kind in made.items() if kind == (k, is_key)] for is_key in (True, False))
        hits, wrong = sum(i in found for i in keys), sum(i in found for i in others)
        assert hits >= 0.9 * len(keys), (k, hits, least)
        assert wrong <= max(1, 0.01 * (hits + wrong)), (k, wrong, hits, least)


def test_structured_strings_alone_give_no_span(clashing):
    pick = random.Random(3)
    texts = [held_out_string(pick, pick.randrange(20, 90)) for _ in range(600)]
    texts += ["/usr/local/lib/python3/site-packages/numpy/core", "MyVeryLongCamelCaseClassNameForTesting",
              "https://example.com/articles/2024/03/how-to-build-a-data-pipeline"]
    docs = clashing([(i, f"see {t} there") for i, t in enumerate(texts)])
    assert secret_scan.scan(docs, secret_scan.fit(docs)).where("spans like '%random:%'").count() == 0
    assert secret_scan.thresholds({}) == [math.inf] * len(secret_scan.LENGTHS)


# --------------------------------------------------------------------------------------- quality classifier
def test_score_equals_a_plain_convolution():
    rng = np.random.default_rng(6)
    q = quality_classifier
    net = q.Network(rng.normal(size=(q.INPUTS, q.FILTERS)).astype(np.float32), rng.normal(size=q.FILTERS).astype(np.float32),
                    rng.normal(size=2 * q.FILTERS).astype(np.float32), 0.1)
    for text in ("", "a", "short text", prose(40, 1), prose(200, 2), "é漢" * 300, prose(4000, 3)[:20_011]):
        data = text.encode()
        span = q.BLOCK * q.STRIDE
        blocks = max(1, -(-max(0, len(data) - q.WIDTH + q.STRIDE) // span))
        padded = data + bytes(blocks * span + q.WIDTH)
        pooled = []
        for b in range(blocks):
            top = np.zeros(q.FILTERS)
            for k in range(q.BLOCK):
                at = b * span + k * q.STRIDE
                window = padded[at : at + q.WIDTH]
                x = np.concatenate([q.NUMBERS[byte] for byte in window]).astype(float)
                top = np.maximum(top, x @ net.filters.astype(float) + net.offsets)
            pooled.append(top)
        chunks = [np.maximum(a, b) for a, b in itertools.pairwise(pooled)] or pooled
        z = np.concatenate((np.mean(chunks, axis=0), np.max(chunks, axis=0))) @ net.weights + net.bias
        assert net.score(text) == pytest.approx(1 / (1 + math.exp(-max(-60, min(60, z)))), abs=1e-4)


def test_labels_of_absent_documents_use_no_place(spark, clashing, monkeypatch):
    monkeypatch.setattr(quality_classifier, "train", lambda examples, conf: examples)
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    rows = [(i, prose(5, i)) for i in range(300, 320)] + [(301, prose(5, 900)), (301, prose(5, 901))]
    conf = quality_classifier.Training(rows_a_class=10)
    got = [quality_classifier.learn(clashing(rows[::order]), labels, conf) for order in (1, -1)]
    assert got[0] == got[1] and len(got[0]) == 20


def test_helpers_of_this_file():
    assert shingle_set("a b c d e f") == {tuple("abcde"), tuple("bcdef")} and SPACE.findall(" x\ty ") == ["x", "y"]
