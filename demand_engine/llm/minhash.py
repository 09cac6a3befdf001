"""Near-duplicate documents: universal hash minima, banding, signature
verification, exact confirmation and connected components.

Documents with equal shingle sets are one class from the start; classes are
banded. In a bucket every class is compared with the bucket's smallest id
(a star, so rows grow with the bucket, not its square); each class's best
candidate by signature is confirmed on the full sets, and components are
built by alternating large-star and small-star.

What the stars leave apart is worked off exactly: in buckets that still hold
several components, members outside the bucket's largest component are held
against all members of other components, in blocks of bounded size and bytes.
A pair is looked at in the first bucket that it shares. Pairs whose signatures
agree are compared by their sets, cut to 32 bits, inside the block, which
gives only links that join what it has not joined yet: at most one for each
component in it, however many pairs it compares. These few are confirmed on
the full sets; should one fail (two shingles alike in 32 bits), the pass is
done once more with full sets.

``BANDS`` x ``ROWS`` minima miss a pair at the threshold 0.8 with a chance
of 3e-6 (less above it); nothing else loses a link.

Cases: texts without a word have no set, n_shingles 0, and are linked with
nothing; a null id is linked with nothing, its component is null and it is
kept; rows that share an id are one node (each row keeps its own
n_shingles); an empty table gives no rows; extra columns are kept by
``dedup_documents`` and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .components import components
from .scratch import materialise, settled

BANDS, ROWS = 32, 5
#: Pairs whose signatures agree in fewer places can't reach the threshold
#: (at 0.8 the expected share is 0.8; 0.6 lies more than six deviations below).
SIGNATURE_SLACK = 0.2
#: Members of a bucket that meet in one task, from each side.
BLOCK = 512
#: Candidate pairs of a group that meet in one task, and bytes of sets from
#: each side.
PAIR_BLOCK = 50_000
SET_BYTES = 16 << 20


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = tx.mix(seeds)
    return mixed[:n] | np.uint64(1), mixed[n:]


def minima(shingles: np.ndarray, n: int) -> np.ndarray:
    """``n`` minima of multiply-add hashes of the shingles' upper 32 bits
    (the upper half of a * x + b mod 2**64 is strongly universal)."""
    a, b = _coefficients(n)
    x = shingles >> np.uint64(32)
    low = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(x), 512):
        h = a[:, None] * x[None, i : i + 512]
        h += b[:, None]
        np.minimum(low, h.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """The distinct shingles of word hashes, sorted; a shorter text is one."""
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(tx.shingle_hashes(words, min(k, len(words))))


def _sets(piece: pa.RecordBatch, k: int) -> Iterator[np.ndarray]:
    buf, off = tx.text_bytes(piece.column("text"))
    buf = tx.LOWER[buf]
    starts, ends, at = tx.tokens(buf, off, tx.SPACED)
    ids, words = tx.word_ids(buf, starts, ends)
    hashes = tx.hash_words(words)[ids]
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield shingle_set(hashes[a:b], k)


def _banded(low: np.ndarray) -> np.ndarray:
    """Band keys (a row per document) from minima."""
    by_band = low.reshape(len(low), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(tx.mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(low), BANDS)).copy()
    for r in range(ROWS):
        key = tx.mix(key * np.uint64(0x9E3779B97F4A7C15) + by_band[:, :, r])
    return key


def sketches(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, n_shingles, digest, signature, bands) per row. The signature has
    a byte of each minimum; it and the bands are null without words."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, "text"):
            n, digest, low = [], [], []
            for s in _sets(piece, k):
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                low.append(minima(s, BANDS * ROWS))
            low = np.stack(low)
            bands = _banded(low).astype("<u8")
            signature = [x.tobytes() if m else None for x, m in zip(low.astype("u1"), n, strict=True)]
            keys = [x.view(np.int64).tolist() if m else None for x, m in zip(bands, n, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(signature, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "n_shingles", "digest", "signature", "bands"],
            )

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n_shingles long, digest binary, signature binary, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, members): the sorted shingle hashes of the wanted classes (id,
    rep, digest), one row each. Texts are compressed before the shuffle."""
    src = docs.select(docs[id_col].cast("long").alias("rep"), docs[text_col].alias("text")).where("rep is not null")

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for piece in tx.pieces(batches, "text"):
            texts = [pack.compress(x.as_buffer() if x.is_valid else b"") for x in piece.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([piece.column("rep"), pa.array(texts, pa.binary())], ["rep", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = [unpack.decompress(x.as_py()) for x in part.column("packed")]
                sets = [x.tobytes() for x in _sets(pa.record_batch([pa.array(texts, pa.large_binary())], ["text"]), k)]
                # a row that shares the id but has another set is not the class
                own = pa.array([xxhash.xxh3_128_digest(x) == d for x, d in zip(sets, part.column("digest").to_pylist(), strict=True)])
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.binary())], ["id", "members"]).filter(own)

    found = src.mapInArrow(squeeze, "rep long, packed binary").join(wanted, "rep").select("id", "digest", "packed")
    return found.mapInArrow(run, "id long, members binary").dropDuplicates(["id"])


def agreeing(pairs: DataFrame, sigs: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree in ``least`` places, with ``same``."""
    left = sigs.select(F.col("id").alias("a"), F.col("signature").alias("sig_a"))
    right = sigs.select(F.col("id").alias("b"), F.col("signature").alias("sig_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "u1").reshape(-1, BANDS * ROWS) for c in ("sig_a", "sig_b"))
            same = (x == y).sum(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(same)], ["a", "b", "same"]).filter(pa.array(same >= least))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long, same int")


def _linked(p: np.ndarray, q: np.ndarray, similarity: int) -> bool:
    both = np.concatenate([p, q])
    both.sort(kind="stable")  # two sorted runs
    both = int((both[1:] == both[:-1]).sum())
    return 100 * both >= similarity * (len(p) + len(q) - both)


def confirmed(best: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Links (u, v) among pairs with one ``a`` for each ``b``: each set goes
    to its centre's, so a pair costs one set."""
    centres = sets.join(best.select(F.col("a").alias("id")).distinct(), "id").select(F.col("id").alias("a"), F.col("members").alias("set_a"))
    own = best.join(sets.withColumnRenamed("id", "b"), "b").select("a", "b", "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [_linked(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), similarity) for x, y in zip(batch.column("set_a"), batch.column("members"), strict=True)]
            if good:
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["u", "v"]).filter(pa.array(good))

    return own.join(centres, "a").select("a", "b", "set_a", "members").mapInArrow(run, "u long, v long")


def _named(rows: DataFrame, comps: DataFrame, column: str, out: str) -> DataFrame:
    """``rows`` with the component of the id in ``column`` (itself, if none)."""
    of = comps.select(F.col("node").alias(column), F.col("component").alias(out))
    return rows.join(of, column, "left").withColumn(out, F.coalesce(out, column))


def apart_in_buckets(members: DataFrame, classes: DataFrame, sets: DataFrame, comps: DataFrame, similarity: int, least: int, width: int = 4) -> DataFrame:
    """Links (a, b) between components: members of a bucket outside its
    largest component against all others there, in blocks. Shingles are
    compared by their lowest ``width`` bytes; with 8 the links are exact."""
    named = _named(members.select("key", "id", "n"), comps, "id", "comp")
    sizes = named.groupBy("key", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    buckets = sizes.groupBy("key").agg(F.sum("c").alias("m"), F.sum("s").alias("s"), F.count("*").alias("k"), F.max("c").alias("main_size"), F.max_by(F.struct("comp", "s"), F.struct("c", "comp")).alias("main"))
    blocks = lambda count, shingles: F.greatest(F.ceil(count / BLOCK), F.ceil(shingles * width / SET_BYTES)).cast("int")
    buckets = buckets.where("k > 1").select("key", F.col("main.comp").alias("main"), blocks(F.col("m"), F.col("s")).alias("nr"), blocks(F.col("m") - F.col("main_size"), F.col("s") - F.col("main.s")).alias("nl"))
    found = materialise(named.join(buckets, "key"), "apart")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = [np.frombuffer(x.as_buffer(), "<u8").astype(f"<u{width}").tobytes() for x in batch.column("members")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(short, pa.binary())], ["id", "members"])

    wanted = sets.join(found.select("id").distinct(), "id", "left_semi").select("id", "members").mapInArrow(cut, "id long, members binary")
    rows = found.join(classes.select("id", "signature", "bands").join(wanted, "id"), "id")
    spread = F.xxhash64("id", F.lit(3))
    left = rows.where("comp <> main").select("*", F.pmod(spread, "nl").alias("l"), F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("r"))
    right = rows.select("*", F.pmod(spread, "nr").cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.col("nl") - 1)).alias("l"))
    columns = ["key", F.col("l").cast("int").alias("l"), F.col("r").cast("int").alias("r"), "id", "n", "comp", "signature", "bands", "members"]

    def compare(key: tuple, x: pa.Table, y: pa.Table) -> pa.Table:
        out: list[tuple[int, int]] = []
        if x.num_rows and y.num_rows:
            sx, sy = (np.frombuffer(b"".join(t.column("signature").to_pylist()), "u1").reshape(t.num_rows, -1) for t in (x, y))
            bx, by = (t.column("bands").combine_chunks().flatten().to_numpy().reshape(t.num_rows, BANDS) for t in (x, y))
            (ix, nx, cx), (iy, ny, cy) = (tuple(t.column(c).to_numpy() for c in ("id", "n", "comp")) for t in (x, y))
            mx, my = ([np.sort(np.frombuffer(v.as_buffer(), f"<u{width}")) for v in t.column("members")] for t in (x, y))
            root: dict[int, int] = {}

            def find(c: int) -> int:
                while (up := root.get(c, c)) != c:
                    root[c] = c = root.get(up, up)
                return c

            for i in range(len(ix)):
                same = (sy == sx[i]).sum(1)
                good = np.flatnonzero((same >= least) & (cy != cx[i]) & (np.minimum(ny, nx[i]) * 100 >= np.maximum(ny, nx[i]) * similarity))
                good = good[by[good, np.argmax(by[good] == bx[i], axis=1)] == key[0].as_py()] if len(good) else good
                for j in good.tolist():
                    a, b = find(int(cx[i])), find(int(cy[j]))
                    if a != b and _linked(mx[i], my[j], similarity):
                        root[a] = b
                        out.append((int(ix[i]), int(iy[j])))
        return pa.table({"a": pa.array([v[0] for v in out], pa.int64()), "b": pa.array([v[1] for v in out], pa.int64())})

    keys = ("key", "l", "r")
    left, right = (t.select(*columns).select(*(F.col(c).alias(c) for c in t.select(*columns).columns)) for t in (left, right))
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "a long, b long")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def confirmed_in_groups(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Links (u, v) of any pairs (a, b): pairs are grouped by connection, the
    members of a large group dealt into blocks, and the pairs of two blocks
    meet in one task with the sets that they name."""
    label = components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")))
    of = label.select(F.col("node").alias("id"), F.col("component").alias("g"))
    named = pairs.join(of.withColumnRenamed("id", "a"), "a")
    n_pairs = named.groupBy("g").agg(F.count("*").alias("n_pairs"))
    sizes = of.join(sets.select("id", F.octet_length("members").alias("size")), "id").groupBy("g").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    # either keeps the pairs of two blocks to PAIR_BLOCK, also where one member has most pairs
    by_pairs = F.least(F.ceil(F.col("n") / max(1, int(PAIR_BLOCK**0.5))), F.ceil(F.col("n_pairs") / PAIR_BLOCK))
    blocks = materialise(n_pairs.join(sizes, "g").select("g", F.greatest(by_pairs, F.ceil(F.col("size") / SET_BYTES)).cast("int").alias("blocks")), "blocks")
    x, y = (F.pmod(F.xxhash64(c, F.lit(5)), "blocks").cast("int") for c in ("a", "b"))
    dealt = materialise(named.join(blocks, "g").select("g", F.least(x, y).alias("l"), F.greatest(x, y).alias("r"), "a", "b"), "dealt")
    members = dealt.select("g", "l", "r", F.explode(F.array("a", "b")).alias("id")).distinct().join(sets, "id")
    members = members.select(*(F.col(c).alias(c) for c in ("g", "l", "r")), "id", "members")  # not the columns of dealt

    def run(key: tuple, todo: pa.Table, own: pa.Table) -> pa.Table:
        got = {i: np.frombuffer(x.as_buffer(), "<u8") for i, x in zip(own.column("id").to_pylist(), own.column("members"), strict=True)}
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = x = root.get(up, up)
            return x

        out = []
        for a, b in zip(todo.column("a").to_pylist(), todo.column("b").to_pylist(), strict=True):
            # pairs that are connected here already need no comparison
            if find(a) != find(b) and _linked(got[a], got[b], similarity):
                out.append((a, b))
                root[find(a)] = find(b)
        return pa.table({"u": pa.array([x[0] for x in out], pa.int64()), "v": pa.array([x[1] for x in out], pa.int64())})

    keys = ("g", "l", "r")
    return dealt.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(run, "u long, v long")


def _still_apart(pairs: DataFrame, comps: DataFrame) -> bool:
    """Whether the ends of some pair lie in different components."""
    named = _named(_named(pairs, comps, "a", "x"), comps, "b", "y")
    return not named.where("x <> y").isEmpty()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: int = 80) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept. Written to
    the shared folder when it is called; the tables it takes on the way are
    deleted then."""
    return settled(docs.sparkSession, lambda: _near_duplicates(docs, id_col, text_col, shingle, similarity), "near-duplicates")


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: int) -> DataFrame:
    drawn = materialise(sketches(docs, id_col, text_col, shingle), "sketches")
    usable = drawn.where("id is not null and n_shingles > 0").withColumn("id", F.col("id").cast("long"))
    # a class of equal sets is numbered by its digest and held by its smallest id
    reps = usable.groupBy("digest").agg(F.min("id").alias("id"))
    classes = usable.join(reps, ["digest", "id"], "left_semi").dropDuplicates(["digest"]).withColumn("rep", F.col("id")).withColumn("id", F.xxhash64("digest"))
    classes = materialise(classes, "classes")
    sigs = classes.select("id", "signature")

    banded = classes.select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("key")).repartition("key")
    centres = banded.groupBy("key").agg(F.count("*").alias("m"), F.min("id").alias("centre"), F.min_by("n", "id").alias("centre_n")).where("m > 1")
    members = materialise(banded.join(centres, "key").select("key", "id", "n", "centre", "centre_n"), "buckets")

    sized = F.least("n", "centre_n") * 100 >= F.greatest("n", "centre_n") * similarity
    least = int(BANDS * ROWS * (similarity / 100 - SIGNATURE_SLACK))
    stars = members.where((F.col("id") != F.col("centre")) & sized).select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    pairs = agreeing(stars, sigs, least)
    best = materialise(pairs.groupBy("b").agg(F.max_by("a", F.col("same")).alias("a")), "best")

    wanted = classes.select("id", "rep", "digest").join(members.select("id").distinct(), "id")
    sets = materialise(full_sets(docs, wanted, id_col, text_col, shingle), "sets")
    links = materialise(_same_id(usable).union(confirmed(best, sets, similarity)), "links")
    comps = components(links)
    for width in (4, 8):
        rest = materialise(apart_in_buckets(members, classes, sets, comps, similarity, least, width), "rest")
        links = links.union(materialise(confirmed_in_groups(rest, sets, similarity), "links"))
        comps = components(links)
        if not _still_apart(rest, comps):  # all links held
            break

    # the smallest id of all rows in a component, through their classes
    of_class = _named(reps.select(F.xxhash64("digest").alias("id"), "digest", F.col("id").alias("rep")), comps, "id", "component")
    lowest = of_class.groupBy("component").agg(F.min("rep").alias("component_id"))
    root = of_class.join(lowest, "component").select("digest", "component_id")
    out = drawn.select("id", "n_shingles", "digest").join(root, "digest", "left")
    alone = F.col("id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id")).cast(drawn.schema["id"].dataType)
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (F.col("id").isNull() | (F.col("id") == component)).alias("kept"))


def _same_id(usable: DataFrame) -> DataFrame:
    """Links between classes that share an id (repeated ids with different
    texts): each to the least of that id's classes."""
    rows = usable.select("id", F.xxhash64("digest").alias("u")).distinct()
    least = rows.groupBy("id").agg(F.min("u").alias("v"), F.count("*").alias("n")).where("n > 1").select("id", "v")
    return rows.join(least, "id").select("u", "v")


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: int = 80) -> DataFrame:
    """The documents, one of each component (the smallest id), with their
    columns; of rows that share an id one stays."""
    found = near_duplicates(docs, id_col, text_col, shingle, similarity)
    gone = found.where("not kept").select(F.col(id_col).alias("its_id")).distinct()
    packed = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("th"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    stay = packed.join(gone, packed["id"] == gone["its_id"], "left_anti")
    one = stay.where("id is not null").groupBy("id").agg(F.min_by("row", "th").alias("row")).select("row")
    stay = one.union(stay.where("id is null").select("row"))
    return stay.select(*(F.col("row")[c].alias(c) for c in docs.columns))
