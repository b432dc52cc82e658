"""Operator 9: n-gram Jaccard join, size-aware with a heavy and a light part.

Documents of the same shingle set form a class; one set of each class is joined.
Shingles have one global order: by how often a fixed-size count sketch of all
documents has seen them, rare first, then by hash. A set of n shingles that
reaches the threshold with another has at least ceil(0.8 n) of its shingles in
common with it, so its first n - ceil(0.8 n) + l shingles hold l of the common ones.

* light: for sets below the boundary every 2-subset of the first
  n - ceil(0.8 n) + 2 shingles is an entry; few unlike sets share two rare shingles.
* heavy: for sets from the boundary on each of the first n - ceil(0.8 n) + 1
  shingles is an entry of an inverted list.

Partners differ in size by a factor of 1.25 at most, so sets up to 1.25 times the
boundary are entered in both. The boundary is the size that makes entries
and list scans cheapest for the table's histogram of sizes.

Lists are scanned in steps. First every set is compared with one set of its list,
the same one in most lists of a group: near copies cost a comparison or two each.
In lists whose sets are still in several components, every set is then compared
with a set of another component, chosen by hash for each list.
At last, all pairs across components of a list are compared, where sizes, places in
the order and parity sketches (each set's shingles counted modulo 2 in 1024 bins:
two sets differ by at least as many shingles as bins) allow the threshold at all.
Sets of one component need no more comparisons. Every comparison is exact, on the
shingles of whole texts.

A NULL or word-free text has an empty set and no links. A NULL doc_id takes no
part (its component is NULL). Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from applens.llm.common import mix, release_memory, shingle_hashes, write_bucketed, write_shared
from applens.llm.components import components

SKETCH_BITS = 20
SKETCH_PARTS = 64
SCAN_COST = 3.0       # of a list entry, against one to make it
MAX_BOUNDARY = 256
PAIRS_AT_ONCE = 200   # texts compared with one copy of the other text
ROUNDS = 1            # of comparisons with a set chosen by hash
WORDS = 16            # 64-bit words of a parity sketch
SLICE = 512


PARITY = [f"k{i}" for i in range(WORDS)]


def _texts(batches, *columns: str):
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            piece = batch.slice(at, SLICE)
            yield from zip(*[piece.column(c).to_pylist() for c in columns], strict=True)


def _signatures(width: int):
    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        rows: dict[str, list] = {"doc_id": [], "n": [], "a": [], "b": [], "parity": []}

        def table():
            n = len(rows["n"])
            return pa.RecordBatch.from_pydict({
                "part": pa.nulls(n, pa.int32()), "counts": pa.nulls(n, pa.binary()),
                "doc_id": pa.array(rows["doc_id"], pa.int64()), "n": pa.array(rows["n"], pa.int64()),
                "a": pa.array(rows["a"], pa.int64()), "b": pa.array(rows["b"], pa.int64()),
                **{f"k{i}": pa.array([p[i] for p in rows["parity"]], pa.int64()) for i in range(WORDS)}})

        for doc_id, text in _texts(batches, "doc_id", "text"):
            h = shingle_hashes(text, width)
            if doc_id is not None:
                np.add.at(sketch, (h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            rows["doc_id"].append(doc_id)
            rows["n"].append(len(h))
            rows["a"].append(int(mix(h).sum(dtype=np.uint64).view(np.int64)))
            rows["b"].append(int(mix(h ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64).view(np.int64)))
            odd = np.bincount((h & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
            rows["parity"].append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            if len(rows["n"]) >= 4096:
                yield table()
                rows = {k: [] for k in rows}
        yield table()
        release_memory()
        parts = [p.tobytes() for p in np.split(np.minimum(sketch, 2**16 - 1).astype(np.uint16), SKETCH_PARTS)]
        if sketch.any():
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(range(SKETCH_PARTS), pa.int32()), "counts": pa.array(parts, pa.binary()),
                **{k: pa.nulls(SKETCH_PARTS, pa.int64()) for k in ("doc_id", "n", "a", "b", *PARITY)}})

    return run


def _add_counts(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(p, np.uint16).astype(np.int64) for p in table.column("counts").to_pylist())
    return pa.table({"part": table.column("part")[:1],
                     "counts": pa.array([np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()], pa.binary())})


def least_common(n, num: int = 4, den: int = 5):
    """ceil(0.8 n): the least number of shingles in common with any partner."""
    return -(-n * num // den)


def boundary(sizes: dict[int, int]) -> int:
    """The boundary of the cheapest plan. sizes: sets by number of shingles, larger ones left out."""
    n = np.array(sorted(sizes), np.int64)
    many = np.array([sizes[k] for k in n], float) if len(n) else np.zeros(0)
    first = n - least_common(n) + 1
    light, heavy = many * first * (first + 1) / 2, many * first * (1 + SCAN_COST)
    costs = [light[4 * n < 5 * at].sum() + heavy[n >= at].sum() for at in range(2, MAX_BOUNDARY + 1)]
    return 2 + int(np.argmin(costs))


def _entries(width: int, sketch, limit: int):
    def run(batches):
        counts = sketch.value
        buffer, held = [], 0
        seen_here: set[int] = set()  # copies are entered once a task, before they are dealt

        def table():
            entry, sid, n, place = (np.concatenate(x) for x in zip(*buffer, strict=True))
            return pa.RecordBatch.from_pydict({
                "entry": pa.array(entry.view(np.int64)), "sid": pa.array(sid),
                "n": pa.array(n), "place": pa.array(place)})

        for doc_id, text in _texts(batches, "doc_id", "text"):
            h = shingle_hashes(text, width)
            n = len(h)
            if n < 2 or doc_id is None:
                continue
            sid = int(mix(h).sum(dtype=np.uint64).view(np.int64))
            if sid in seen_here:
                continue
            seen_here.add(sid)
            first = n - least_common(n) + 2
            seen = counts[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            head = np.argsort(seen, kind="stable")[:first]  # equal counts: by hash, as h is in order
            head = h[head]
            found = []
            if 4 * n < 5 * limit:
                i, j = np.triu_indices(len(head), 1)
                found.append((mix(mix(head[i]) + head[j] * np.uint64(3)), i))
            if n >= limit:
                found.append((head[:first - 1], np.arange(min(first - 1, len(head)))))
            for entry, place in found:
                k = len(entry)
                buffer.append((entry, np.full(k, sid), np.full(k, n, np.int32), place.astype(np.int32)))
                held += k
            if held >= 1 << 16:
                yield table()
                buffer, held = [], 0
        if buffer:
            yield table()
        release_memory()

    return run


def _compare(width: int, percent: int):
    """Rows come ordered by (a, salt, role): a text of `a`, then those to compare with it."""
    def run(batches):
        key, own, a_out, b_out = None, None, [], []
        for a, salt, b, text in _texts(batches, "a", "salt", "b", "text"):
            h = shingle_hashes(text, width)
            if b is None:
                key, own = (a, salt), h
                continue
            if key != (a, salt):
                raise ValueError("a pair without its first text")
            common = len(np.intersect1d(own, h, assume_unique=True))
            if 100 * common >= percent * (len(own) + len(h) - common):
                a_out.append(a)
                b_out.append(b)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a_out, pa.int64()), "b": pa.array(b_out, pa.int64())})

    return run


def _links(pairs: DataFrame, texts: DataFrame, width: int, percent: int, parts: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold; `texts` is bucketed by sid, so that only the pairs
    are dealt to it. A set in very many pairs is spread over salts."""
    n = F.count(F.lit(1)).over(Window.partitionBy("a"))
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(n / F.lit(PAIRS_AT_ONCE))).cast("int"))
    ask = (pairs.select("a", "salt", F.col("b"), F.col("b").alias("sid"))
           .unionByName(pairs.select("a", "salt").distinct()
                        .select("a", "salt", F.lit(None).cast("long").alias("b"), F.col("a").alias("sid"))))
    sent = (ask.join(texts, "sid").select("a", "salt", "b", "text")
            .repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()))
    return sent.mapInArrow(_compare(width, percent), "a bigint, b bigint")


def _can_reach(n, m, i, j, percent: int):
    """Whether sets of n and m shingles whose first common ones have places i and j can reach the threshold."""
    return 100 * F.least(F.col(n) - F.col(i), F.col(m) - F.col(j)) * (100 + percent) >= percent * 100 * (F.col(n) + F.col(m))


def _may_reach(percent: int):
    """Whether the sketches of x and y leave a Jaccard similarity of the threshold possible."""
    differ = sum((F.bit_count(F.col(f"x_{k}").bitwiseXOR(F.col(f"y_{k}"))) for k in PARITY[1:]),
                 F.bit_count(F.col("x_k0").bitwiseXOR(F.col("y_k0"))))
    return differ * (100 + percent) <= (100 - percent) * (F.col("x_n") + F.col("y_n"))


def jaccard_groups(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id linked with it, directly or through others).

    One row per row of `docs` (doc_id long, text). The threshold is a Jaccard
    similarity of 0.8 of the sets of `width`-word shingles.
    """
    percent = 80
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    signed = write_shared(docs.mapInArrow(
        _signatures(width), "part int, counts binary, doc_id bigint, n bigint, a bigint, b bigint, "
        + ", ".join(f"{k} bigint" for k in PARITY)), "signatures")
    sets = signed.filter("part IS NULL").select("doc_id", "n", "a", "b")
    counts = dict(signed.filter("part IS NOT NULL").select("part", "counts")
                  .groupBy("part").applyInArrow(_add_counts, "part int, counts binary").collect())
    step = (1 << SKETCH_BITS) // SKETCH_PARTS
    sketch = spark.sparkContext.broadcast(np.concatenate(
        [np.frombuffer(counts[p], np.uint32) if p in counts else np.zeros(step, np.uint32) for p in range(SKETCH_PARTS)]))
    limit = boundary(dict(sets.filter(f"n BETWEEN 2 AND {2 * MAX_BOUNDARY}").groupBy("n").count().collect()))

    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    by = Window.partitionBy("entry")
    # Dealt once, by entry: copies from other tasks and the scan of the lists need no other exchange.
    entries = (docs.mapInArrow(_entries(width, sketch, limit), "entry bigint, sid bigint, n int, place int")
               .repartition(parts, "entry").distinct())
    chosen = F.min(F.struct(F.xxhash64("sid"), "sid", "n", "place")).over(by)
    lists = write_shared(
        entries.withColumn("many", F.count(F.lit(1)).over(by)).filter("many > 1").withColumn("c", chosen)
        .select("entry", "sid", "n", "place", F.col("c.sid").alias("c"), F.col("c.n").alias("cn"), F.col("c.place").alias("cp")),
        "lists")

    classes = sets.filter("n > 0 AND doc_id IS NOT NULL").groupBy("a", "b", "n").agg(F.min("doc_id").alias("least"))
    listed = lists.select("sid").distinct()
    wanted = classes.join(listed, F.col("a") == F.col("sid")).select("sid", F.col("least").alias("doc_id"))
    texts, forget = write_bucketed(docs.join(wanted, "doc_id").select("sid", "text"), "texts", "sid", parts)

    def compared(pairs: DataFrame) -> DataFrame:
        return write_shared(_links(pairs, texts, width, percent, parts), "links")

    pairs = lists.filter((F.col("sid") != F.col("c")) & _can_reach("n", "cn", "place", "cp", percent)) \
        .select(F.col("c").alias("a"), F.col("sid").alias("b")).distinct()
    links = compared(pairs)
    near = components(links)
    open_lists = lists.select("entry", "sid", "n", "place")
    for turn in range(ROUNDS + 1):
        named = open_lists.drop("label").join(near.withColumnRenamed("node", "sid"), "sid", "left") \
            .withColumn("label", F.coalesce("label", "sid")).repartition(parts, "entry")
        open_lists = write_shared(
            named.withColumn("lo", F.min("label").over(by)).withColumn("hi", F.max("label").over(by))
            .filter("lo <> hi").drop("lo", "hi"), "open")
        if open_lists.isEmpty() or turn == ROUNDS:
            break
        other = F.min(F.struct(F.xxhash64("sid", "entry", F.lit(turn)), "sid", "n", "place", "label")).over(by)
        stars = (open_lists.withColumn("c", other)
                 .select("sid", "n", "place", "label", *[F.col(f"c.{k}").alias(f"c_{k}") for k in ("sid", "n", "place", "label")])
                 .filter((F.col("label") != F.col("c_label")) & _can_reach("n", "c_n", "place", "c_place", percent))
                 .select(F.least("sid", "c_sid").alias("a"), F.greatest("sid", "c_sid").alias("b")).distinct())
        links = links.unionByName(compared(stars))
        near = components(links)

    sketches = signed.filter("part IS NULL AND n > 0").select(F.col("a").alias("sid"), *PARITY).dropDuplicates(["sid"])
    left = open_lists.join(sketches, "sid")
    x, y = (left.select("entry", *[F.col(c).alias(f"{side}_{c}") for c in ("sid", "n", "place", "label", *PARITY)]) for side in "xy")
    across = (x.join(y, "entry").filter((F.col("x_sid") < F.col("y_sid")) & (F.col("x_label") != F.col("y_label"))
                                        & _can_reach("x_n", "y_n", "x_place", "y_place", percent) & _may_reach(percent))
              .select(F.col("x_sid").alias("a"), F.col("y_sid").alias("b")).distinct())
    more = compared(across)
    forget()
    if not more.isEmpty():
        near = components(links.unionByName(more))

    named = classes.join(near.select(F.col("node").alias("a"), "label"), "a", "left") \
        .withColumn("label", F.coalesce("label", "a"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(least, "label").select("a", "b", "n", "component_id")
    return sets.join(named, ["a", "b", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
