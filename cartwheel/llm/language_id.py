"""Language identification by compression.

For each language a raw-content zstandard dictionary is cut from labelled texts. A text is cut into pieces of
``PIECE`` bytes, every piece is compressed with every dictionary, and the language with the smallest total
wins. The score sets the winner against the runner-up; an operator caller may reject narrow margins.

Learning considers every piece of ``SNIPPET`` characters of every labelled text. A language's dictionary is made of its distinct
pieces of least hash, ``DICTIONARY`` bytes of them: a place in a long text counts like any other, and copies count
once. Only the dictionaries reach the driver and the tasks: ``ALL_DICTIONARIES`` bytes at most, shared out if there are
more languages than fit at full size, and ``MOST_LANGUAGES`` of them (those with most text; a dirty column has many rare values).

A text that is null or has no letter (a character of a Unicode letter category) is ``und`` with score 0. With no learned language every text is ``und``.
Equal sizes go to the language first in alphabetical order. Rows are independent of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, map_arrow

DICTIONARY = 96 * 1024
SNIPPET = 1024
PIECE = 4096
LEVEL = 6
ALL_DICTIONARIES = 200 * DICTIONARY
MOST_LANGUAGES = 2000
SPARE = 8  # pieces looked at for one that is taken
UNKNOWN = "und"
_KEEP = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


def letters(text: str) -> bytes:
    """Lower-cased words of letters, one space between: case, digits and symbols say little about a language."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_KEEP).split())


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def learn(rows: DataFrame) -> dict[str, bytes]:
    """Dictionary content of each language from rows (text, lang)."""
    text = column("text").cast("string")
    usable = rows.select(column("lang").cast("string").alias("lang"), text.alias("text"))
    usable = usable.where("lang is not null and char_length(text) > 0")
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{SNIPPET}}}"), F.lit(0))
    pieces = usable.select("lang", F.explode(cut).alias("piece")).withColumn("hash", F.xxhash64("piece"))
    share = F.approx_count_distinct("hash")
    known = pieces.groupBy("lang").agg(share.alias("n"), F.sum(F.char_length("piece")).alias("size"))
    known = known.orderBy(F.desc("size"), "lang").limit(MOST_LANGUAGES).collect()
    if not known:
        return {}
    limit = min(DICTIONARY, ALL_DICTIONARIES // len(known))
    wanted = -(-limit // SNIPPET) * 4  # letters may be few in a piece
    # least hashes: a bound on the hash leaves enough pieces of every language, whatever its size
    bounds = {r["lang"]: min(1.0, SPARE * wanted / max(1, r["n"])) for r in known}
    table = rows.sparkSession.createDataFrame(list(bounds.items()), "lang string, share double")
    level = (F.col("hash").cast("double") / 2.0**64) + 0.5
    near = pieces.join(F.broadcast(table), "lang").where(level <= F.col("share")).drop("share")
    order = Window.partitionBy("lang").orderBy("hash", "piece")
    sample = near.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= wanted)
    texts: dict[str, list[tuple[int, bytes]]] = {}
    for r in sample.select("lang", "n", "piece").toLocalIterator():
        texts.setdefault(r["lang"], []).append((r["n"], letters(r["piece"])))
    return {k: b" ".join(t for _, t in sorted(v) if t)[:limit] for k, v in sorted(texts.items())}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self.languages = sorted(dictionaries)
        self.compressors = []
        for name in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=content, write_checksum=False, write_content_size=False
                ).compress
            )

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin): score is the runner-up's share of the two best sizes, margin their gap."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, 0.0
        data = letters(text)
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        sizes = [sum(len(c(p)) for p in pieces) for c in self.compressors]
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        best = sizes[order[0]]
        if len(order) == 1:
            return self.languages[0], 1.0, 1.0
        second = sizes[order[1]]
        return self.languages[order[0]], second / (best + second), (second - best) / second


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.0, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns, lang_pred, score, margin and rejected (margin under ``min_margin``) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries).classify
        for batch in batches:
            found = [classify(t) for t in batch.column(len(keep)).to_pylist()]
            columns = [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[2] for f in found], pa.float64()),
                pa.array([f[2] < min_margin for f in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), *columns],
                [*keep, "lang_pred", "score", "margin", "rejected"],
            )

    rows = docs.select(*[column(c) for c in keep], column("text").cast("string").alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_arrow(rows, run, f"{kinds}, lang_pred string, score double, margin double, rejected boolean")
