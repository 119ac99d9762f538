"""Language ID by compression: the language whose dictionary makes the text smallest.

A zstandard raw-content dictionary for each language holds text of labelled documents.  A text is cut into pieces of
some KB, all of which are compressed with each, every piece afresh; the smallest sum names the language.  So later
parts count like the first, and the margin to the second doesn't shrink with length.  Where sums are within a few
bytes, a closer search over smaller pieces is added.  A narrow margin rejects the text, where asked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

SAMPLE_DOCS = 600  # learned from at most so many documents of each language, those of smallest hash
DICTIONARY_BYTES = 1 << 17  # and about so many bytes of each language, an equal run of each document from a hashed place
ALL_BYTES = 200 * DICTIONARY_BYTES  # and of all languages together: where there are many, each has fewer
PIECE = 4096  # the most bytes of a text that are compressed at once: few beside a dictionary, so that the text isn't its own
OUT = "lang_pred string, score double, margin double"
NO_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")


def plain(text: str) -> str:
    """Lower-case words alone: case, punctuation and numbers say little about the language; '' without a letter."""
    words = NO_LETTERS.sub(" ", text.lower()).strip()
    return words if LETTER.search(words) else ""


def sampled(labelled: DataFrame, sample: int) -> DataFrame:
    """doc_id, lang, h, n (documents of the language in the sample): at most `sample` of each language, by hash."""
    ids = labelled.where("lang is not null and text is not null").select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    # hashes are spread evenly, so a share of their range holds the smallest of them and little more
    share = F.least(F.lit(1.0), F.lit(1.5 * sample + 50) / F.col("rows"))
    counts = C.save(ids.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    near = ids.join(counts, "lang").where(F.col("h") <= F.lit(-(2.0**63)) + share * F.lit(2.0**64)).select("doc_id", "lang", "h").distinct()
    near = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(F.col("r") <= sample)
    near = C.save(near.select("doc_id", "lang", "h"), "language-sample")
    return near.join(near.groupBy("lang").agg(F.count("*").alias("n")), "lang")


def dictionaries(labelled: DataFrame, sample: int = SAMPLE_DOCS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A dictionary for each lang from rows doc_id, text, lang; the sample is bounded, its choice is the same on every run.

    Lines that stand in several languages, such as licences, tell nothing and are left out.  Rows without text or
    lang teach nothing; documents of one doc_id and lang count once; without any rows there are no dictionaries.
    """
    chosen = sampled(labelled, sample)
    size = min(size, max(1024, ALL_BYTES // max(1, chosen.select("lang").distinct().count())))
    texts = labelled.where("text is not null").join(chosen, ["doc_id", "lang"]).groupBy("lang", "doc_id", "h", "n").agg(F.min("text").alias("text"))
    line = F.trim(F.regexp_replace(F.lower("line"), r"[^\p{L}\p{M}]+", " "))
    lines = texts.select("lang", "doc_id", "h", "n", F.posexplode(F.split("text", "\n")).alias("i", "line")).withColumn("line", line).where("line <> ''")
    lines = C.save(lines.groupBy("lang", "doc_id", "h", "n", "line").agg(F.min("i").alias("i")), "language-lines")
    common = lines.groupBy("line").agg(F.min("lang").alias("a"), F.max("lang").alias("b")).where("a <> b").select("line")
    own = lines.join(common, "line", "left_anti").groupBy("lang", "doc_id", "h", "n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]), " ").alias("text"))
    share = F.greatest(F.lit(64), F.floor(F.lit(size) / F.col("n"))).cast("int")
    start = F.pmod(F.xxhash64("h", F.lit(1)), F.greatest(F.lit(1), F.length("text") - share + 1)).cast("int") + 1
    runs = own.select("lang", "h", F.col("text").substr(start, share).alias("run"))
    # `size` characters of each language and ALL_BYTES of all reach the driver at most
    out: dict[str, list[str]] = {}
    for r in sorted(runs.collect(), key=lambda r: (r["lang"], r["h"], r["run"])):
        out.setdefault(r["lang"], []).append(f" {r['run']} ")
    return {k: " ".join(v).encode() for k, v in out.items()}


def pieces(raw: bytes, most: int = PIECE) -> list[bytes]:
    """All of raw in nearly equal pieces of at most so many bytes."""
    n = max(1, -(-len(raw) // most))
    cuts = [len(raw) * i // n for i in range(n + 1)]
    return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


class Judge:
    """Tells languages by the sizes that learned dictionaries leave; one serves a whole task."""

    def __init__(self, learned: dict[str, bytes], level: int = 3) -> None:
        self.learned, self.langs = learned, sorted(learned)
        self.quick, self.fine = self.compressors(level), None

    def compressors(self, level: int) -> list:
        import zstandard as zstd

        made = []
        for k in self.langs:
            d = zstd.ZstdCompressionDict(self.learned[k], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            made.append(zstd.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        return made

    def of(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin): und, 0, 0 if text is null or has no letter or nothing is learned.

        score is the second smallest size over the sum of the two smallest; margin the gain over the second, as a
        share.  Ties go to the language first by code point.
        """
        words = plain(text) if text is not None else ""
        if not words or not self.langs:
            return "und", 0.0, 0.0
        raw = f" {words} ".encode()
        cuts = pieces(raw)
        size = np.array([sum(len(c.compress(x)) for x in cuts) for c in self.quick])
        if len(self.langs) > 1 and np.partition(size, 1)[1] - size.min() <= 4:
            # whole bytes are coarse where so few decide: add up what halves, words and a closer search take
            self.fine = self.fine or self.compressors(19)
            cuts = [*cuts, *pieces(raw, min(PIECE, (len(raw) + 1) // 2)), *(b" " + w + b" " for w in raw.split())]
            size = size + np.array([sum(len(c.compress(x)) for x in cuts) for c in self.fine])
        best = int(size.argmin())
        second = float(np.partition(size, 1)[1]) if len(self.langs) > 1 else float(2 * size[best])
        return self.langs[best], second / (second + float(size[best])), 1 - float(size[best]) / second


def judge(texts, learned: dict[str, bytes]):
    told = Judge(learned)
    return map(told.of, texts)


def predict(docs: DataFrame, learned: dict[str, bytes]) -> DataFrame:
    """docs with lang_pred, score and margin (columns of those names are replaced); only text is looked at.

    Every row is judged alone, so repeated rows agree; a null text, or one without a letter, or any text where nothing
    is learned, is und with score and margin 0; an empty table gives none.
    """
    rest = docs.drop("lang_pred", "score", "margin")
    names = [*rest.columns, "lang_pred", "score", "margin"]
    at = rest.columns.index("text")

    def run(batches):
        told = Judge(learned)
        for batch in batches:
            cols = list(zip(*(told.of(x.as_py()) for x in batch.column(at)), strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.float64())], names=names)
            C.tidy()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return rest.mapInArrow(run, f"{kinds}, {OUT}")


def remainder():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Dictionaries from the documents that aren't held out (crc32 of doc_id as text, mod 4, is not 2)."""
    return dictionaries(docs.where(remainder() != 2).select("doc_id", "text", "lang"))


def accepted(docs: DataFrame, learned: dict[str, bytes], margin: float) -> DataFrame:
    """The rows whose language is clear: not und, and ahead of the second by margin; their columns as they were."""
    at = docs.columns.index("text")

    def run(batches):
        told = Judge(learned)
        for batch in batches:
            got = (told.of(x.as_py()) for x in batch.column(at))
            yield batch.filter(pa.array([lang != "und" and ahead >= margin for lang, _, ahead in got], pa.bool_()))
            C.tidy()

    return docs.mapInArrow(run, docs.schema)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin; a null doc_id is neither held out nor learned from."""
    docs = C.documents(spark, sf_dir)
    rows = docs.select("doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "text")
    return predict(rows, learn(docs)).drop("text")
