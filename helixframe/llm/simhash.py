"""Operator 8: near duplicates by SimHash with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments. Of two or fewer differing bits some segment i has
none while segment i+1 has at most one (pigeonhole), so each fingerprint gets the keys (i, bits of
segment i, Golay index of segment i+1). The index is the codeword nearest to the segment in the
perfect [23,12,7] Golay code, taken for the segment and every word one bit away (one to a few
distinct indices), so two segments one bit apart share an index. Fingerprints that share a key are joined
and verified. Keys that more than DIRECT fingerprints share name no pairs: their fingerprints are
linked through words one bit away from both, which any two fingerprints within two bits share and
no others do. That is exact and linear in the size of a group.

Null and empty texts have fingerprint zero and are linked like any other. Repeated rows share a
fingerprint; ties can't occur, as classes are named by their smallest key. Texts are read whole, whatever
their length. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import identified, keep, table, text_chunks
from helixframe.llm.graph import components

SHINGLE_WORDS, MAX_BITS, SEED = 3, 2, 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
GOLAY = 0xC75  # generator polynomial of the [23,12,7] code
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


def shingle_hashes(words: list[str], size: int) -> np.ndarray:
    """XXH64 of the shingles, repeats included; of the whole sequence if it is shorter."""
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(" ".join(words), SEED)], np.uint64)
    runs = zip(*(words[i:] for i in range(size)), strict=False)
    return np.array([digest(s, SEED) for s in map(" ".join, runs)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit b is 1 if it is set in over half of the hashes; signed."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """(key, fp) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch, text):
                ids = batch.column(batch.schema.get_field_index(key)).slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array([fingerprint(shingle_hashes(words_of(t), size)) for t in texts], pa.int64())], names=[key, "fp"])

    return docs.select(key, text).mapInArrow(run, f"{key} long, fp long")


@cache
def _decoder() -> tuple[np.ndarray, np.ndarray]:
    """(syndrome of each value of each byte of a word, error pattern of each syndrome)."""

    def syndrome(w: np.ndarray) -> np.ndarray:
        w = w.copy()
        for bit in range(22, 10, -1):
            w ^= ((w >> bit) & 1) * (GOLAY << (bit - 11))
        return w

    of_byte = syndrome(np.arange(256)[None, :] << np.array([0, 8, 16])[:, None] & (1 << 23) - 1)
    one = 1 << np.arange(23)
    errors = [[0], one, [a | b for a, b in combinations(one, 2)], [a | b | c for a, b, c in combinations(one, 3)]]
    pattern = np.concatenate([np.array(e, np.int64) for e in errors])
    of_syndrome = np.zeros(1 << 11, np.int64)
    of_syndrome[syndrome(pattern)] = pattern
    return of_byte, of_syndrome


def golay_index(words: np.ndarray) -> np.ndarray:
    """The number (12 bits) of the codeword within three bits of each 23-bit word."""
    of_byte, of_syndrome = _decoder()
    syndrome = of_byte[0][words & 255] ^ of_byte[1][words >> 8 & 255] ^ of_byte[2][words >> 16]
    return (words ^ of_syndrome[syndrome]) >> 11


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, row of fps) of unsigned fingerprints, each key of a row once."""
    keys, rows = [], []
    parts = [(fps >> np.uint64(at)) & np.uint64((1 << bits) - 1) for at, bits in SEGMENTS]
    for i in range(3):
        j = (i + 1) % 3
        fuzzy = parts[j].astype(np.int64)
        near = np.concatenate([fuzzy[:, None], fuzzy[:, None] ^ (1 << np.arange(SEGMENTS[j][1]))], axis=1)
        found = np.sort(golay_index(near), axis=1)
        new = np.concatenate([np.ones((len(fps), 1), bool), found[:, 1:] != found[:, :-1]], axis=1)
        row = np.nonzero(new)[0]
        keys.append((np.int64(i) << 60) | (parts[i].astype(np.int64)[row] << 12) | found[new])
        rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def fuzzy_keys(distinct: DataFrame) -> DataFrame:
    """(key, fp) of distinct fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 8_192):
                part = fps[at : at + 8_192]
                keys, rows = golay_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], names=["key", "fp"])

    return distinct.select("fp").mapInArrow(run, "key long, fp long")


#: Fingerprints of a key that are compared with one another, at most 31 comparisons each; of a larger key each makes 65 words.
DIRECT = 64


def crowded(keys: DataFrame, shared: DataFrame) -> DataFrame:
    """(fp) of the keys (key, fp) that more than DIRECT fingerprints share, by shared (key, n)."""
    return keys.join(shared.filter(F.col("n") > DIRECT).select("key"), "key", "left_semi").select("fp").distinct()


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints within MAX_BITS of one another, and no others."""
    keys = keep(fuzzy_keys(distinct), "keys")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")
    shared = keep(shared, "shared")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    pairs = shared.filter("n = 2").select("a", "b").distinct().filter(close)
    few = keep(keys.join(shared.filter(F.col("n").between(3, DIRECT)).select("key"), "key"), "few")
    met = few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), "key").filter((F.col("a") < F.col("b")) & close).select("a", "b")
    masks = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(64)])
    near = keep(crowded(keys, shared), "crowded").select("fp", F.explode(masks).alias("mask")).select(F.col("fp").bitwiseXOR(F.col("mask")).alias("middle"), "fp")
    first = near.groupBy("middle").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("middle", "a")
    stars = near.join(first, "middle").filter("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(met).unionByName(stars).distinct()


def classes(prints: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, fp, component_id) for a stored table of (key, fp)."""
    distinct = keep(prints.groupBy("fp").agg(F.min(key).alias("first")), "distinct")
    roots = components(fingerprint_links(distinct)).withColumnsRenamed({"node": "fp"})
    rooted = distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(key, "fp", "component_id")


def op8_simhash_golay(spark, sf_dir: str) -> DataFrame:
    prints = keep(fingerprints(table(spark, sf_dir, "documents")), "prints")
    return classes(prints).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---------------------------------------------------------------- near copies by similarity, for the pipeline

#: Shingle length and similarity of near copies; BANDS x BAND_ROWS minima miss a pair at 0.8 once in 2800.
COPY_WORDS, COPY_SIMILARITY, BANDS, BAND_ROWS = 5, 0.8, 20, 5


def _sketches(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(id, file, at, h, l, fp, bands) of identified rows: digest of the word sequence, fingerprint, hashed bands of shingle minima."""
    factors = np.random.default_rng(SEED).integers(1, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch):
                digests, fps, bands = [], [], []
                for t in texts:
                    words = words_of(t)
                    digests.append(np.frombuffer(xxhash.xxh3_128_digest(" ".join(words)), ">i8"))
                    fps.append(fingerprint(shingle_hashes(words, SHINGLE_WORDS)))
                    h = np.unique(shingle_hashes(words, COPY_WORDS))
                    if not len(h):
                        bands.append(None)
                        continue
                    h ^= h >> np.uint64(29)
                    minima = np.array([(h * f).min() for f in factors], np.uint64).reshape(BANDS, BAND_ROWS)
                    bands.append([xxhash.xxh64_intdigest(bytes([i]) + m.tobytes()) - (1 << 63) for i, m in enumerate(minima)])
                part = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([int(d[0]) for d in digests], pa.int64()), pa.array([int(d[1]) for d in digests], pa.int64()), pa.array(fps, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=["id", "file", "at", "h", "l", "fp", "bands"])

    chosen = rows.select(F.col(f"docs.`{key}`").alias("id"), "file", "at", F.col(f"docs.`{text}`").alias("text"))
    return chosen.mapInArrow(run, "id long, file long, at long, h long, l long, fp long, bands array<long>")


def _shingle_sets(texts: DataFrame) -> DataFrame:
    """(row, shingles) of (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch):
                sets = [np.unique(shingle_hashes(words_of(t), COPY_WORDS)).view(np.int64) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(texts)), pa.array(sets, pa.list_(pa.int64()))], names=["row", "shingles"])

    return texts.select("row", "text").mapInArrow(run, "row long, shingles array<long>")


#: Members of a group on each side of a tile, and shingles of it counted at a time: they bound a step's memory, not the result.
TILE, TILE_SHINGLES = 128, 8192


def _tile_links(frame: pd.DataFrame) -> pd.DataFrame:
    """(a, b): links between alike members of the two sides of a tile; a forest over their roots."""
    sides = [frame[frame["left"]], frame[~frame["left"]]]
    sizes = [np.array([len(x) for x in side["shingles"]], np.int64) for side in sides]
    common = np.zeros((len(sides[0]), len(sides[1])), np.float32)
    if common.size:
        rows = [np.repeat(np.arange(len(n)), n) for n in sizes]
        flat = [np.concatenate(side["shingles"].to_list()) for side in sides]
        met = np.intersect1d(*flat)
        entries = []
        for row, x in zip(rows, flat, strict=True):
            at = np.isin(x, met)
            row, code = row[at], np.searchsorted(met, x[at])
            order = np.argsort(code, kind="stable")
            entries.append((row[order], code[order]))
        for begin in range(0, len(met), TILE_SHINGLES):
            marks = []
            for (row, code), n in zip(entries, sizes, strict=True):
                part = slice(*np.searchsorted(code, [begin, begin + TILE_SHINGLES]))
                mark = np.zeros((len(n), TILE_SHINGLES), np.float32)
                mark[row[part], code[part] - begin] = 1
                marks.append(mark)
            common += marks[0] @ marks[1].T
    common = common.astype(np.float64)
    alike = (common > 0) & (common >= COPY_SIMILARITY * (sizes[0][:, None] + sizes[1][None, :] - common))
    (ids_a, ids_b), (roots_a, roots_b) = ([side[c].to_numpy() for side in sides] for c in ("row", "root"))
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    links = []
    for i, j in zip(*np.nonzero(alike), strict=True):
        a, b = find(int(roots_a[i])), find(int(roots_b[j]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            links.append((ids_a[i], ids_b[j]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def similar_links(groups: DataFrame, texts) -> DataFrame:
    """(a, b): links that connect all rows of a group whose texts are at least COPY_SIMILARITY alike, and no others.

    groups is a stored table (band, row); texts gives (row, text) of a table of rows. First every member
    meets its group's first one, which is dealt over as many places as its members need. Then, in groups
    of several components, each member outside the first one's component meets every member, in tiles of
    TILE by TILE members; groups of the same members count once.
    """
    lead = keep(groups.groupBy("band").agg(F.min("row").alias("a"), F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("row")).alias("members")).filter("n > 1"), "lead")
    lead = lead.groupBy("n", "members", "a").agg(F.min("band").alias("band"))
    grouped = keep(groups.join(lead, "band").select("band", "a", "n", "row"), "grouped")
    met = grouped.filter("row <> a").groupBy("a", F.col("row").alias("b")).agg(F.max("n").alias("n"))
    candidates = keep(met.select("a", "b", F.pmod(F.xxhash64("b", F.lit(SEED)), F.ceil(F.col("n") / TILE)).alias("slot")), "candidates")
    named = candidates.select(F.col("a").alias("row")).unionByName(candidates.select(F.col("b").alias("row"))).distinct()
    sets = keep(_shingle_sets(texts(named)), "sets")
    leaders = candidates.select("a", "slot").distinct().join(sets.withColumnsRenamed({"row": "a", "shingles": "sa"}), "a")
    both = candidates.join(sets.withColumnsRenamed({"row": "b", "shingles": "sb"}), "b").join(leaders, ["a", "slot"])
    common = F.size(F.array_intersect("sa", "sb"))
    verified = keep(both.filter(common >= COPY_SIMILARITY * (F.size("sa") + F.size("sb") - common)).select("a", "b"), "verified")

    roots = keep(components(verified), "roots")
    leader = roots.select(F.col("node").alias("a"), F.col("root").alias("first"))
    labelled = grouped.filter("n > 2").join(roots.withColumnsRenamed({"node": "row"}), "row", "left").join(leader, "a", "left")
    labelled = labelled.select("band", "row", "n", F.coalesce("root", "row").alias("root"), (F.coalesce("root", "row") != F.coalesce("first", "a")).alias("apart"))
    labelled = keep(labelled, "labelled")
    open_groups = labelled.groupBy("band").agg(F.count_if("apart").alias("m")).filter("m > 0")
    sided = labelled.join(open_groups, "band").select("band", "row", "root", "apart", F.ceil(F.col("m") / TILE).cast("int").alias("rows"), F.ceil(F.col("n") / TILE).cast("int").alias("columns"))
    place = F.xxhash64("row", F.lit(SEED))
    left = sided.filter("apart").select("band", "row", "root", F.pmod(place, "rows").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"), F.lit(True).alias("left"))
    right = sided.select("band", "row", "root", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), F.pmod(place, "columns").cast("int").alias("j"), F.lit(False).alias("left"))
    tiled = left.unionByName(right).join(sets, "row")
    return verified.unionByName(tiled.groupBy("band", "i", "j").applyInPandas(_tile_links, "a long, b long"))


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", stored: bool = False) -> DataFrame:
    """Of each group of copies and near copies the row with the smallest key stays (rows without one last, then by place).

    Links: equal word sequences, and texts whose sets of five-word shingles are at least 0.8 alike.
    Candidates of the second kind share a band of minima, or have fingerprints that links of at most
    MAX_BITS connect; all are verified on the whole sets. Rows count on their own, whatever key they share:
    of equal rows one stays, and a copy goes even if its key also names a text of its own. Texts without a
    word, null ones too, are one another's copies. An empty table stays empty; other columns are kept as
    they are. stored: docs is a plain scan of files, which need not be written again.
    """
    rows = identified(docs, stored)
    sketches = keep(_sketches(rows, key, text).withColumn("row", F.monotonically_increasing_id()), "sketches")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row", "file", "at", "fp", "bands"))
    firsts = keep(sketches.groupBy("h", "l").agg(first.alias("s")).select("s.*"), "firsts")
    close = components(fingerprint_links(keep(firsts.select("fp").distinct(), "distinct"))).withColumnsRenamed({"node": "fp"})
    printed = firsts.select("row", "fp").join(close, "fp", "left").select("row", F.xxhash64(F.coalesce("root", "fp"), F.lit(SEED)).alias("band"))
    groups = keep(firsts.select("row", F.explode("bands").alias("band")).unionByName(printed), "groups")

    def texts(named: DataFrame) -> DataFrame:
        places = firsts.select("row", "file", "at").join(named, "row", "left_semi")
        return rows.join(places, ["file", "at"]).select("row", F.col(f"docs.`{text}`").alias("text"))

    roots = keep(components(similar_links(groups, texts)), "roots")
    named = roots.withColumnsRenamed({"node": "row"}).join(firsts.select("row", "no_id", "id"), "row")
    best = named.groupBy("root").agg(F.min(F.struct("no_id", "id", "row")).alias("s")).select("s.row")
    gone = roots.select(F.col("node").alias("row")).join(best, "row", "left_anti")
    stay = firsts.select("row", "file", "at").join(gone, "row", "left_anti").select("file", "at")
    return rows.join(stay, ["file", "at"], "left_semi").select("docs.*")
