"""Operator 4: language identification by compression.

A text is compressed with one zstandard raw-content dictionary per language; the language whose
dictionary gives the fewest bytes wins (ties: smaller name). Narrow margins are rejected.

Null texts and texts without a letter are 'und' with score 0 and rejected. Rows with a null language
teach nothing; with no language learned every text is 'und'. Equal texts have equal predictions;
languages that compress a text alike go by name. An empty table gives an empty result. Texts are read
whole, in training as well, and compressed in pieces. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import crc_mod, keep, table, text_chunks

#: Documents of a language that are drawn, bytes of its dictionary, and of the pieces drawn from the documents: the bounds of the sample.
DOCUMENTS, DICTIONARY_BYTES, SAMPLE_BYTES = 256, 32 << 10, 1 << 10
LEVEL = 6
#: Texts are compressed in pieces of so many bytes, so that long ones don't become their own dictionary.
PIECE_BYTES = 8 << 10
#: Texts under so many bytes are also compressed from later words on: whole bytes are too coarse for one measurement.
SHORT_BYTES, SHORT_STARTS = 1 << 10, 8
#: Rejected below this share by which the best size undercuts the second.
MIN_MARGIN = 0.002
_OTHER = re.compile(r"[\W\d_]+")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", dictionary_bytes: int = DICTIONARY_BYTES, documents: int = DOCUMENTS) -> dict[str, bytes]:
    """A raw-content dictionary per language, of pieces drawn by hash from anywhere in the texts of documents that are drawn by hash.

    Each language's documents are cut to their bound before they meet in one task.
    """
    known = docs.filter(F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(lang).alias("lang"), F.shiftrightunsigned(F.xxhash64(key), 2).alias("draw"), F.col(key).alias("key"))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return {}
    # so few documents of a language are ranked that its group stays small
    limits = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, int(min(1.0, 4 * documents / n) * (1 << 62)))])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "key"))
    chosen = known.filter(F.col("draw") <= F.element_at(limits, F.col("lang"))).withColumn("place", place).filter(F.col("place") <= documents).select("lang", "key").distinct()
    chosen = keep(chosen, "chosen")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for begin, texts in text_chunks(batch, "text"):
                for name, t in zip(batch.column(0).slice(begin, len(texts)).to_pylist(), texts, strict=True):
                    raw = normalise(t).encode()
                    rows += [(name, p, xxhash.xxh64_intdigest(p) >> 1) for p in (raw[i : i + SAMPLE_BYTES] for i in range(0, len(raw), SAMPLE_BYTES))]
            names, parts, draws = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(parts, pa.binary()), pa.array(draws, pa.int64())], names=["lang", "piece", "draw"])

    texts = docs.select(F.col(lang).alias("lang"), F.col(key).alias("key"), F.col(text).alias("text"))
    texts = texts.join(F.broadcast(chosen), (texts.lang == chosen.lang) & texts.key.eqNullSafe(chosen.key), "left_semi")  # at most documents a language
    pieces = texts.select("lang", "text").mapInArrow(cut, "lang string, piece binary, draw long")
    place, size = Window.partitionBy("lang").orderBy("draw", "piece"), F.sum(F.length("piece") + 1)
    # whole pieces can't overrun by more than one; the number that fits is cut off before the running sum
    most = dictionary_bytes // (SAMPLE_BYTES // 8) + 1
    held = pieces.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= most)
    held = held.withColumn("end", size.over(place.rowsBetween(Window.unboundedPreceding, -1))).filter(F.coalesce("end", F.lit(0)) < dictionary_bytes)
    out: dict[str, list[bytes]] = {}
    for r in sorted(held.select("lang", "place", "piece").collect(), key=lambda r: (r.lang, r.place)):
        out.setdefault(r.lang, []).append(bytes(r.piece))
    return {name: b"\n".join(parts)[:dictionary_bytes] for name, parts in out.items()}


def normalise(text: str) -> str:
    """Letters in lower case, everything else as single spaces: layout and punctuation say nothing of the language."""
    return _OTHER.sub(" ", text).lower()


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries)
        self.compressors = []
        for name in self.names:
            d = zstd.ZstdCompressionDict(dictionaries[name], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(zstd.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        raw = normalise(text).encode()
        if len(raw) < SHORT_BYTES:
            words = raw.split(b" ")
            pieces = [b" ".join(words[len(words) * k // SHORT_STARTS :]) for k in range(min(SHORT_STARTS, len(words)))]
        else:
            pieces = [raw[i : i + PIECE_BYTES] for i in range(0, len(raw), PIECE_BYTES)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin)."""
        if not self.names or not text or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min((s for i, s in enumerate(sizes) if i != best), default=None)
        if second is None:
            return self.names[best], 1.0, 1.0
        return self.names[best], 1 / (1 + (sizes[best] / second) ** 32), 1 - sizes[best] / second


def identify(docs: DataFrame, dictionaries: dict[str, bytes], key: str = "doc_id", text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """(key, lang_pred, score, margin, rejected) of each text; keeps the input's partitions."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # at most languages x dictionary_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(shared.value)
        for batch in batches:
            for begin, texts in text_chunks(batch, text):
                found = [model.predict(t) for t in texts]
                ids = batch.column(batch.schema.get_field_index(key)).slice(begin, len(texts))
                langs, scores, margins = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([ids, pa.array(langs), pa.array(scores), pa.array(margins), pa.array([g == "und" or m < min_margin for g, _, m in found])], names=[key, "lang_pred", "score", "margin", "rejected"])

    return docs.select(key, text).mapInArrow(run, f"{key} long, lang_pred string, score double, margin double, rejected boolean")


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    out = identify(docs, fit(docs.filter(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Pipeline stage: drops the documents that language identification rejects, in one pass over them.

    Null texts and those without a letter go; where no language is known, all do. Copies go or stay together.
    Other columns stay as they are; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs.filter(crc_mod("doc_id", 4) != 2)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(shared.value)
        for batch in batches:
            mask: list[bool] = []
            for _, texts in text_chunks(batch):
                found = [model.predict(t) for t in texts]
                mask += [g != "und" and m >= MIN_MARGIN for g, _, m in found]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
