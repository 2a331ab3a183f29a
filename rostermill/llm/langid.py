"""Language of a text: the dictionary that compresses it best.

For every language a raw-content zstandard dictionary is cut from labelled
texts. A text is lower-cased and compressed, block by block, once with each
dictionary; the language with the smallest total wins. When the runner-up is
nearly as small the text is close to no language in particular and can be
rejected.

Fitting looks at a bounded sample (``Fit``): a fixed number of labelled rows a
language, and a window of fixed length from each. What the driver gathers is
``languages * rows * window`` characters, however large the table is.
Predicting reads whole texts, in one pass and without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rostermill.llm.bpe import slices

UNKNOWN = "und"


@dataclass(frozen=True)
class Fit:
    """Bounds of the sample and of the dictionaries."""

    #: labelled rows per language, those of lowest text hash
    rows: int = 400
    #: characters taken from each of them, at a place given by the hash
    window: int = 400
    #: bytes of a dictionary
    dictionary: int = 65_536
    #: bytes compressed at once, so that a text's own repetitions count little
    block: int = 1024
    #: compression level; blocks under ``short`` bytes use ``short_level``
    level: int = 6
    short: int = 256
    short_level: int = 12


@dataclass(frozen=True)
class Model:
    """Dictionaries by language, the language of most labelled rows first.

    An earlier language wins a tie.
    """

    dictionaries: tuple[tuple[str, bytes], ...]
    fit: Fit


def train(docs: DataFrame, fit: Fit = Fit(), text: str = "text", lang: str = "lang") -> Model:
    """Dictionaries from labelled rows; rows without label or text are skipped.

    Equal texts count once. With no labelled row the model has no languages
    and everything is unknown.
    """
    letters = F.col(text).rlike(r"\p{L}")
    labelled = docs.where(F.col(lang).isNotNull() & letters).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("order")
    )
    room = F.greatest(F.length("text") - fit.window, F.lit(0)) + 1
    windows = labelled.select(
        "lang", "order", F.substr("text", (F.pmod("order", room) + 1).cast("int"), F.lit(fit.window)).alias("text")
    )
    # the rows of lowest hash, cut by a threshold before they meet: a language's
    # window gets about twice the wanted rows, however many there are
    sizes = labelled.groupBy("lang").agg(F.approx_count_distinct("order").alias("texts")).collect()
    room = F.lit(0).cast("long")
    for row in sizes:
        share = min(1.0, 2 * fit.rows / max(1, row["texts"]))
        room = F.when(F.col("lang") == row["lang"], F.lit(int(share * 2**64) - 2**63 - 1)).otherwise(room)
    windows = windows.where(F.col("order") <= room)
    rank = F.dense_rank().over(Window.partitionBy("lang").orderBy("order"))
    sample = (
        windows.withColumn("rank", rank).where(F.col("rank") <= fit.rows).groupBy("lang", "rank").agg(F.min("text").alias("text"))
    )
    parts: dict[str, list[tuple[int, str]]] = {}
    for row in sample.collect():
        parts.setdefault(row["lang"], []).append((row["rank"], row["text"]))
    frequent = {r[0]: -r[1] for r in docs.where(F.col(lang).isNotNull()).groupBy(F.col(lang)).count().collect()}
    names = sorted(parts, key=lambda name: (frequent[name], name))
    return Model(
        tuple(
            (name, "\n".join(t.lower() for _, t in sorted(parts[name])).encode()[-fit.dictionary :])
            for name in names
        ),
        fit,
    )


def _compressors(model: Model, level: int) -> list[zstandard.ZstdCompressor]:
    made = []
    for _, content in model.dictionaries:
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=level)
        made.append(
            zstandard.ZstdCompressor(
                level=level, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return made


class Classifier:
    """Compressors of a model, made once per task."""

    def __init__(self, model: Model):
        self.names = [name for name, _ in model.dictionaries]
        self.fit = model.fit
        self.long = _compressors(model, self.fit.level)
        self.short = _compressors(model, self.fit.short_level)

    def sizes(self, text: str) -> list[int]:
        data, block = text.lower().encode(), self.fit.block
        sizes = [0] * len(self.names)
        for start in range(0, len(data), block):
            part = data[start : start + block]
            for at, by in enumerate(self.long if len(part) >= self.fit.short else self.short):
                sizes[at] += len(by.compress(part))
        return sizes

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin of one text.

        The margin is the share by which the best size is below the second
        best; the score grows with it from 0.5 (a tie) towards 1.
        """
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.names[best], 1.0, 1.0
        second = min(s for at, s in enumerate(sizes) if at != best)
        margin = 1.0 - sizes[best] / second
        return self.names[best], min(1.0, 0.5 + 2.5 * margin), margin


def predict(
    docs: DataFrame, model: Model, text: str = "text", keep: dict[str, Column] | None = None, least_margin: float = 0.004
) -> DataFrame:
    """Language of every row.

    Returns the columns of ``keep`` (by default doc_id), then lang_pred,
    score, margin and rejected. A text that is null or has no letter is
    ``und`` with score 0 and is rejected; a margin under ``least_margin`` is
    rejected too, but keeps its best guess.
    """
    keep = keep if keep is not None else {"doc_id": F.col("doc_id")}
    narrow = docs.select(F.col(text).alias("_text"), *[c.alias(name) for name, c in keep.items()])
    kept = [*keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Classifier(model)
        for batch in batches:
            for part in slices(batch):
                found = [by.classify(t) for t in part.column(0).to_pylist()]
                margins = [m for _, _, m in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[1:],
                        pa.array([name for name, _, _ in found], pa.string()),
                        pa.array([score for _, score, _ in found], pa.float64()),
                        pa.array(margins, pa.float64()),
                        pa.array([n == UNKNOWN or m < least_margin for n, _, m in found], pa.bool_()),
                    ],
                    names=[*kept, "lang_pred", "score", "margin", "rejected"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[1:])
    return narrow.mapInArrow(run, f"{kinds}, lang_pred string, score double, margin double, rejected boolean")


def keep_known(docs: DataFrame, model: Model, text: str = "text", least_margin: float = 0.004) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    names = docs.columns
    marked = predict(docs, model, text, {f"c{at}": F.col(f"`{c}`") for at, c in enumerate(names)}, least_margin)
    return marked.where(~F.col("rejected")).select(*[F.col(f"c{at}").alias(c) for at, c in enumerate(names)])
