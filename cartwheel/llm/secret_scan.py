"""Secret scan: three patterns, and a battery of randomness tests for strings that no pattern names.

The base patterns give the spans ``assign``, ``access`` and ``hex``. The method adds ``random`` spans: strings of
``CANDIDATE`` characters that look drawn at random from their alphabet. A string's encoding is inferred (hex, base32 or
base64) and three tests are run under draws at random from it: chi-squared for uniform use of the alphabet, whose cells part the
cases, digits, and letters that are common or rare in writing; the number of runs of one kind of character; and serial
correlation, how often vowels and consonants alternate. Fisher's rule joins their p-values into one: tiny for strings that
are written, spread evenly for random ones.

False discoveries are controlled in each class of length, as short strings carry little evidence. The known false cases are
``NULL_DRAWS`` structured strings a class, drawn from ``NULL_WORDS`` by fixed rules: slugs, paths, identifiers in several styles, run-on words,
with numbers here and there. At a threshold t, the share of these that pass, times the candidates of the class, bounds the false
ones among them; the threshold is the least t at which this is at most ``FALSE_DISCOVERY`` of the candidates that pass. A class
with too little evidence is pooled with its neighbours, and if no threshold will do, nothing is added there. The histograms behind it
count every document.

A null or empty text has no spans. Spans are in code points, end exclusive. Rows are independent of each other.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_arrow, map_same

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

LEAST_LENGTH = 20
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Letters by how often they are written in the languages of western Europe, and the vowels.
COMMON, MIDDLE, RARE = "etaoinsr", "hldcumfpg", "wybvkxjqz"
VOWELS = "aeiou"
#: Cells of equal draws, and kinds of character whose runs are counted, by encoding.
CELLS = {
    "hex": ("01234", "56789", "ae", "bcdf"),
    "base32": (COMMON.upper(), MIDDLE.upper(), RARE.upper(), "234567"),
    "base64": (COMMON, MIDDLE, RARE, COMMON.upper(), MIDDLE.upper(), RARE.upper(), "0123456789+/"),
}
LETTERS = {"hex": ("0123456789", "abcdef"), "base32": ("234567", (COMMON + MIDDLE + RARE).upper())}
LETTERS["base64"] = ("0123456789+/", COMMON + MIDDLE + RARE, (COMMON + MIDDLE + RARE).upper())
CELL_OF = {name: {c: k for k, cell in enumerate(cells) for c in cell} for name, cells in CELLS.items()}
KIND_OF = {name: {c: k for k, kind in enumerate(kinds) for c in kind} for name, kinds in LETTERS.items()}
LENGTHS = (20, 24, 32, 48, 64, 128)
FALSE_DISCOVERY = 0.01
BINS = 96
BINS_A_DECADE = 16
NULL_DRAWS = 4000
NULL_SEED = 7
#: What structured strings are made of; any written words will do.
NULL_WORDS = (
    "server client request response user account session data model train test index value config build deploy cache queue "
    "stream table report update create delete search result image header content message handler manager service factory "
    "quarterly analysis introduction weather mountain children government development international communication "
    "strasse freundschaft entwicklung gesellschaft wirtschaft maison travail semaine toujours bibliotheque "
    "ciudad trabajo historia desarrollo siempre universidad www com org html php main src lib usr bin home docs api"
).split()

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the three patterns. Runs of 16 or more hex digits are just the whole runs that are long enough."""
    found: list[Span] = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def encoding(string: str) -> str | None:
    """The smallest alphabet that holds the string; None for plain numbers."""
    bare = set(string.rstrip("="))
    if bare <= set("0123456789"):
        return None
    if bare <= KIND_OF["hex"].keys() or bare <= set("0123456789ABCDEF"):
        return "hex"
    if bare <= KIND_OF["base32"].keys():
        return "base32"
    return "base64"


def _normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_squared_tail(x: float, k: int) -> float:
    """Upper tail for k degrees of freedom (Wilson and Hilferty's cube-root rule; exact for two)."""
    if x <= 0:
        return 1.0
    if k == 2:
        return math.exp(-x / 2)
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _pairs_p(hits: int, pairs: int, chance: float, both: float) -> float:
    """Two-sided p-value of ``hits`` among ``pairs`` neighbours; ``both``: the chance that two pairs with a common character hit."""
    if pairs < 2:
        return 1.0
    spread = pairs * chance * (1 - chance) + 2 * (pairs - 1) * (both - chance * chance)
    return _normal_two_sided((hits - pairs * chance) / math.sqrt(max(spread, 1e-9)))


def randomness(string: str, name: str) -> float:
    """Joint p-value of the three tests, under draws at random from the alphabet ``name``."""
    bare = string.rstrip("=").replace("-", "+").replace("_", "/")
    bare = bare.lower() if name == "hex" else bare
    cell_of, kind_of = CELL_OF[name], KIND_OF[name]
    chars = [c for c in bare if c in cell_of]
    n, size = len(chars), len(cell_of)
    if n < 8:
        return 0.0
    counts = Counter(map(cell_of.__getitem__, chars))
    wanted = [n * len(cell) / size for cell in CELLS[name]]
    chi = sum((counts[k] - w) ** 2 / w for k, w in enumerate(wanted))
    uniform = _chi_squared_tail(chi, len(wanted) - 1)
    shares = [len(kind) / size for kind in LETTERS[name]]
    kinds = [kind_of[c] for c in chars]
    same = sum(p * p for p in shares)
    alike = sum(a == b for a, b in zip(kinds, kinds[1:], strict=False))
    runs = _pairs_p(alike, n - 1, same, sum(p**3 for p in shares))
    # vowels and consonants, where two letters follow each other
    vowel = [None if kind == 0 else c.lower() in VOWELS for c, kind in zip(chars, kinds, strict=True)]
    pairs = [(a, b) for a, b in zip(vowel, vowel[1:], strict=False) if a is not None and b is not None]
    v = 2 / 6 if name == "hex" else 5 / 26
    serial = _pairs_p(sum(a != b for a, b in pairs), len(pairs), 2 * v * (1 - v), v * (1 - v))
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, runs, serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def candidates(text: str) -> Iterator[tuple[int, int, int, float]]:
    """(start, end, length class, p-value) of each candidate string; words and plain numbers are none."""
    if not any(len(w) >= LEAST_LENGTH for w in text.split()):
        return
    for m in CANDIDATE.finditer(text):
        string = m.group()
        name = encoding(string)
        if name is not None and not WORD.fullmatch(string):
            yield (*m.span(), bisect_right(LENGTHS, len(string)) - 1, randomness(string, name))


def p_bin(p: float) -> int:
    return min(BINS - 1, int(-BINS_A_DECADE * math.log10(max(p, 1e-300))))


def structured(pick: random.Random, length: int) -> str:
    """A string of ``length`` characters as people and programs write them."""
    style = pick.choice(("slug", "snake", "path", "camel", "Camel", "CONST", "flat", "query"))
    joint = {"slug": "-", "snake": "_", "path": "/", "CONST": "_", "query": pick.choice("=-_/+")}.get(style, "")
    parts: list[str] = ["", ""] if style == "path" and pick.random() < 0.5 else []
    while sum(map(len, parts)) + len(joint) * len(parts) < length + 1:
        if parts and pick.random() < 0.12:
            part = str(pick.choice((pick.randrange(10), pick.randrange(100), pick.randrange(1990, 2030), pick.randrange(10**6))))
        else:
            part = pick.choice(NULL_WORDS)
        if style == "CONST":
            part = part.upper()
        elif style == "Camel" or style == "camel" and parts:
            part = part.capitalize()
        parts.append(part)
    return joint.join(parts)[:length]


@lru_cache(maxsize=1)
def null_histograms() -> list[Counter]:
    """Counts of p-value bins of structured strings, by length class."""
    pick, found = random.Random(NULL_SEED), []
    for k, least in enumerate(LENGTHS):
        most = LENGTHS[k + 1] if k + 1 < len(LENGTHS) else 2 * least
        seen: Counter = Counter()
        while seen.total() < NULL_DRAWS:
            string = structured(pick, pick.randrange(least, most))
            name = encoding(string)
            if name is not None and not WORD.fullmatch(string) and CANDIDATE.fullmatch(string):
                seen[p_bin(randomness(string, name))] += 1
        found.append(seen)
    return found


def fit(docs: DataFrame) -> list[float]:
    """The p-value threshold of each length class, from counts over all documents (bounded histograms)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update((k, p_bin(p)) for _, _, k, p in candidates(text or ""))
        rows = sorted(seen.items())
        columns = [[k[0] for k, _ in rows], [k[1] for k, _ in rows], [n for _, n in rows]]
        kinds = (pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["class", "bin", "n"]
        )

    counted = map_arrow(docs.select(column("text").cast("string")), run, "class int, bin int, n long")
    rows = counted.groupBy("class", "bin").agg(F.sum("n").alias("n")).collect()
    return thresholds({(r["class"], r["bin"]): r["n"] for r in rows})


def thresholds(histogram: dict[tuple[int, int], int], null: list[Counter] | None = None) -> list[float]:
    """The least p-value of each class that keeps the bound on false discoveries; infinite where none does."""
    null = null or null_histograms()

    def least(classes: range) -> float:
        seen, known, best = Counter(), Counter(), math.inf
        for k in classes:
            seen.update({b: histogram.get((k, b), 0) for b in range(BINS)})
            known.update(null[k])
        passed = false = 0
        for b in range(BINS):
            passed, false = passed + seen[b], false + known[b]
            if passed and (false + 1) / (known.total() + 1) * seen.total() <= FALSE_DISCOVERY * passed:
                best = 10 ** (-(b + 1) / BINS_A_DECADE)
        return best

    out = []
    for k in range(len(LENGTHS)):
        reach, best = 0, least(range(k, k + 1))
        while math.isinf(best) and reach < len(LENGTHS):
            reach += 1
            best = least(range(max(0, k - reach), min(len(LENGTHS), k + reach + 1)))
        out.append(best)
    return out


def scan_text(text: str | None, least_p: list[float]) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans): a random span is added unless one base span holds it whole."""
    if not text:
        return [], []
    base = base_spans(text)
    added = [
        ("random", a, b)
        for a, b, k, p in candidates(text)
        if p >= least_p[k] and not any(s <= a and b <= e for _, s, e in base)
    ]
    return base, sorted([*base, *added], key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, least_p: list[float]) -> DataFrame:
    """doc_id, the base counts, base_sha256 and spans of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text in batch.column(1).to_pylist():
                base, every = scan_text(text, least_p)
                kinds = Counter(k for k, _, _ in base)
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                for column, value in zip(out, (*map(kinds.__getitem__, KINDS[:3]), digest, joined(every)), strict=True):
                    column.append(value)
            arrays = [pa.array(c, pa.int64() if i < 3 else pa.string()) for i, c in enumerate(out)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            )

    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").cast("string").alias("text"))
    kinds = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_arrow(rows, run, kinds)


def redacted_text(text: str, spans: list[Span], mark: str) -> str:
    """``text`` with the union of the spans replaced, one mark for each stretch."""
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, least_p: list[float], mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret span of ``text`` replaced, and ``n_chars`` set anew where that column exists."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(place).to_pylist():
                _, spans = scan_text(text, least_p)
                texts.append(redacted_text(text, spans, mark) if spans else text)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    done = map_same(docs, run)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.char_length(column("text")).cast(kind))
    return done
