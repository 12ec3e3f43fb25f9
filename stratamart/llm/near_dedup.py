"""Near duplicates: SuperMinHash signatures, banding, verification on full shingle sets, connected components.

1. One pass over the texts makes, per document, the size of its shingle set, a
   128-bit key of the set and its SuperMinHash signature. Documents with equal
   sets are one class; everything after works on classes, so any number of exact
   copies costs one row.
2. Signatures are cut into bands. Classes that share a band meet in a bucket.
   First each class is checked against the bucket minimum it shares most bands
   with; verified links give first components.
3. A bucket that still holds several components is searched between them: its
   smaller components are compared with all its members, in cells of two bounded
   parts, first by signature, then, of those near another, by the 32-bit prefixes
   of all shingle hashes. A pair is compared only in the first bucket it shares, and a class needs one link to
   another component, so it names its two most similar members there. So no pair
   inside a component is ever formed, none across components is left out, and
   what leaves a task does not grow with the square of a group.
4. Links are confirmed by exact intersection of the full sets, fetched for
   bucket members only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import doc_bytes, mix64, slices, stored, text_mark, without
from .components import components

SLOTS, BANDS = 128, 32
CHUNK = 512
PART = 2048
CELL_BYTES = 16_000_000
ROW_BYTES = 600  # of a member, without its shingles
PERCENT = 80
PIVOTS = 4  # of its buckets' pivots a text is compared with first; the comparison across components finds the rest
MARGIN = 0.17  # five standard deviations of an estimate of 0.8 from 128 slots
ELEMENTS = 250_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


def shingle_set(text: bytes, words: int) -> set[bytes]:
    """Distinct runs of ``words`` words, lower-cased A-Z; a shorter text is one run, a text without words has none."""
    w = text.lower().split()
    if len(w) < words:
        return {b" ".join(w)} if w else set()
    return set(map(b" ".join, zip(*(w[i:] for i in range(words)))))


def hashed(shingles: set[bytes]) -> np.ndarray:
    """Sorted 64-bit hashes of the shingles."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, shingles), np.uint64, len(shingles))
    h.sort()
    return h


def superminhash(elements: np.ndarray, owner: np.ndarray, sets: int, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures, ``sets`` x ``slots``, of the sets that own the elements (uint64 hashes).

    Every element visits the slots in a random order of its own, one per level;
    its value at a level is the level plus a random fraction, so a slot keeps the
    least. Once all slots of a set were filled on levels so far, later levels
    cannot lower any, and its elements stop.
    """
    best = np.full(sets * slots, np.iinfo(np.uint64).max, np.uint64)
    picks: list[np.ndarray] = []
    for level in range(slots):
        if not len(elements):
            break
        with np.errstate(over="ignore"):
            x = mix64(elements + np.uint64(level + 1) * GOLDEN)
        pick = (level + (((x & _LOW) * np.uint64(slots - level)) >> np.uint64(32)).astype(np.int64)).astype(np.int16)
        at = pick
        for earlier in range(level - 1, -1, -1):  # undo the swaps of the element's shuffle so far
            at = np.where(at == picks[earlier], np.int16(earlier), at)
        np.minimum.at(best, owner * slots + at, (np.uint64(level) << np.uint64(32)) | (x >> np.uint64(32)))
        picks.append(pick)
        done = best.reshape(sets, slots).max(1) < (np.uint64(level + 1) << np.uint64(32))
        go = ~done[owner]
        if not go.all():
            elements, owner, picks = elements[go], owner[go], [p[go] for p in picks]
    return (mix64(best.reshape(sets, slots)) >> np.uint64(32)).astype(np.uint32)


def _sign(words: int):
    def flush(ids, marks, sets):
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        signed = superminhash(np.concatenate(sets) if sets else np.zeros(0, np.uint64), owner, len(sets))
        keys = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets]
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array([int(k[0]) for k in keys], pa.int64()),
            pa.array([int(k[1]) for k in keys], pa.int64()),
            pa.array([r.tobytes() if n else b"" for r, n in zip(signed, sizes)], pa.binary()), pa.array(marks, pa.int64())],
            names=["doc_id", "n", "k1", "k2", "signature", "mark"])

    def run(batches):
        for b in batches:
            ids, marks, sets, held = [], [], [], 0
            for part in slices(b):
                for doc_id, text, mark in zip(*(part.column(i).to_pylist() for i in range(3))):
                    ids.append(doc_id)
                    marks.append(mark)
                    sets.append(hashed(shingle_set(text, words)))
                    held += len(sets[-1])
                    if held >= ELEMENTS:
                        yield flush(ids, marks, sets)
                        ids, marks, sets, held = [], [], [], 0
            if ids:
                yield flush(ids, marks, sets)
    return run


def _bands(batches):
    for b in batches:
        if not b.num_rows:
            continue
        signed = np.frombuffer(b"".join(b.column("signature").to_pylist()), np.uint32).reshape(-1, BANDS, SLOTS // BANDS)
        key = np.zeros(signed.shape[:2], np.uint64)
        with np.errstate(over="ignore"):
            key += np.arange(1, BANDS + 1, dtype=np.uint64) * GOLDEN
            for i in range(signed.shape[2]):
                key = mix64(key ^ signed[:, :, i].astype(np.uint64))
            key = key - key % np.uint64(BANDS) + np.arange(BANDS, dtype=np.uint64)  # the band's number stays readable
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(b.column("node").to_numpy(), BANDS)),
                                          pa.array(np.repeat(b.column("n").to_numpy(), BANDS))], names=["band", "node", "n"])


def _sets(words: int):
    def run(batches):
        for b in (part for batch in batches for part in slices(batch)):
            nodes, sets = [], []
            for node, k1, k2, text in zip(*(b.column(c).to_pylist() for c in ("node", "k1", "k2", "text"))):
                s = hashed(shingle_set(text, words)).tobytes()
                if tuple(np.frombuffer(xxhash.xxh3_128_digest(s), np.int64)) == (k1, k2):
                    nodes.append(node)
                    sets.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "elements"])
    return run


def _confirm(percent: int):
    def run(batches):
        for b in (part for batch in batches for part in slices(batch)):
            u, v = [], []
            for a, c, x, y in zip(*(b.column(k).to_pylist() for k in ("u", "v", "x", "y"))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    u.append(a)
                    v.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("elements").alias("x"))
    right = sets.select(F.col("node").alias("v"), F.col("elements").alias("y"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "x", "y").mapInArrow(_confirm(percent), "u long, v long")


def _prefixes(batches):
    for b in (part for batch in batches for part in slices(batch)):
        cut = [(np.frombuffer(x, np.uint64) >> np.uint64(32)).astype(np.uint32).tobytes() for x in b.column("elements").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(cut, pa.binary())], names=["node", "prefixes"])


def _near_rows(key, table, least: float, percent: int):
    """Yield (row of a probe, rows of other components near it by signature) of one cell."""
    band, low, high, apart, i, j = (k.as_py() for k in key)
    probe, base = (table.column(c).to_numpy(zero_copy_only=False) for c in ("probe", "base"))
    comp, n = (table.column(c).to_numpy() for c in ("component", "n"))
    signed = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, SLOTS)
    inside = low == high and i == j and not apart  # a part against itself
    against = np.arange(len(n)) if inside else np.flatnonzero(base)
    for k in np.flatnonzero(probe if inside else ~base):
        other = against[(comp[against] != comp[k]) & (100 * np.minimum(n[against], n[k]) >= percent * np.maximum(n[against], n[k]))]
        equal = signed[other] == signed[k]
        first = equal.reshape(len(other), BANDS, SLOTS // BANDS).all(2).argmax(1)
        near = other[(equal.mean(1) >= least) & (first == band % BANDS)]
        if len(near):
            yield k, near


def _hits(percent: int):
    """The rows of a cell that are near another by signature; only these get their shingles."""
    def run(key, table):
        hit = np.zeros(table.num_rows, bool)
        for k, near in _near_rows(key, table, percent / 100 - MARGIN, percent):
            hit[k] = True
            hit[near] = True
        return table.filter(pa.array(hit))
    return run


def _across(percent: int):
    def run(key, table):
        node, comp, n = (table.column(c).to_numpy() for c in ("node", "component", "n"))
        prefixes, own = table.column("prefixes"), {}
        u, v = [], []
        for i, near in _near_rows(key, table, percent / 100 - MARGIN, percent):
            for j in near:
                if j not in own:
                    own[j] = np.frombuffer(prefixes[int(j)].as_py(), np.uint32)
            mine = np.frombuffer(prefixes[int(i)].as_py(), np.uint32)
            every = np.concatenate([own[j] for j in near])
            at = np.minimum(np.searchsorted(mine, every), len(mine) - 1)
            sizes = n[near]
            both = np.add.reduceat((mine[at] == every).astype(np.int64), np.cumsum(sizes) - sizes)
            share = both / (sizes + n[i] - both)
            linked = np.flatnonzero(100 * both >= percent * (sizes + n[i] - both))
            told: dict[int, int] = {}
            for k in linked[np.argsort(-share[linked], kind="stable")]:
                j = near[k]
                told[comp[j]] = told.get(comp[j], 0) + 1
                if told[comp[j]] <= 2:
                    u.append(max(node[j], node[i]))
                    v.append(min(node[j], node[i]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})
    return run


def _cells(members: DataFrame, labels: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Members of mixed buckets, dealt to cells in which all pairs between components meet, each in one cell.

    A bucket of up to CHUNK members is one cell. The members of a larger one are
    divided by size of the set, so that similar sets are in the same or the next
    division, by whether they are of the largest component, and by hash into parts
    of at most about PART members and CELL_BYTES. A cell is a pair of parts, so its
    size does not grow with the bucket. Two parts of the largest component never meet.
    """
    named = members.join(labels, "node", "left").select("band", "node", "n", F.coalesce("component", "node").alias("component"))
    room = F.lit(ROW_BYTES) + 4 * F.col("n")
    sizes = named.groupBy("band", "component").agg(F.count("*").alias("c"), F.sum(room).alias("bytes"))
    mixed = sizes.groupBy("band").agg(F.sum("c").alias("size"), F.sum("bytes").alias("bytes"), F.count("*").alias("parts"),
                                      F.max_by("component", "c").alias("largest")).filter("parts > 1")
    wide = 1.000001 * max(1.25, 100 / percent)
    named = stored(named.join(mixed, "band").select(
        "band", "node", "n", "component", (F.col("component") != F.col("largest")).alias("probe"),
        ((F.col("size") <= CHUNK) & (F.col("bytes") <= CELL_BYTES)).alias("small"),
        F.floor(F.log(F.col("n")) / F.log(F.lit(wide))).cast("int").alias("part")), "mixed-buckets")
    parts = named.filter("NOT small").groupBy("band", "part", "probe").agg(F.count("*").alias("c"), F.sum(room).alias("bytes"))
    parts = parts.select("band", "part", "probe", F.greatest(F.ceil(F.col("c") / PART), F.ceil(F.col("bytes") / CELL_BYTES)).cast("int").alias("k"))
    others = parts.select("band", F.col("part").alias("part2"), F.col("probe").alias("probe2"), F.col("k").alias("k2"))
    roles = parts.join(others, "band").filter("abs(part - part2) <= 1 AND (probe OR probe2)")
    rows = named.join(roles, ["band", "part", "probe"], "left").filter("small OR k2 IS NOT NULL").join(classes.select("node", "signature"), "node")
    own, last = F.pmod(F.xxhash64("node"), F.col("k")).cast("int"), F.col("k2") - 1
    # the lower part of two of the same kind is the probe side, and of two kinds the one outside the largest component
    side = F.when(F.col("probe") & F.col("probe2"), F.col("part") > F.col("part2")).otherwise(~F.col("probe"))
    rows = (rows.withColumn("own", F.when(F.col("small"), F.lit(0)).otherwise(own))
                .withColumn("other", F.explode(F.when(F.col("small"), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), last)))))
    same = F.col("probe") & F.col("probe2") & (F.col("part") == F.col("part2"))
    base = F.when(F.col("small"), F.lit(False)).when(same, F.col("own") > F.col("other")).otherwise(side)
    flat = lambda x, y: F.when(F.col("small"), F.lit(-1)).when(F.col("base"), y).otherwise(x)
    rows = rows.withColumn("base", base)
    return rows.select("band", flat(F.col("part"), F.col("part2")).alias("low"), flat(F.col("part2"), F.col("part")).alias("high"),
                       F.when(F.col("small"), F.lit(False)).otherwise(F.col("probe") != F.col("probe2")).alias("apart"),
                       F.when(F.col("base"), F.col("other")).otherwise(F.col("own")).alias("i"),
                       F.when(F.col("base"), F.col("own")).otherwise(F.col("other")).alias("j"),
                       "base", "probe", "node", "component", "n", "signature")


_CELL = ["band", "low", "high", "apart", "i", "j"]
_CELLS = ("band long, low int, high int, apart boolean, i int, j int, base boolean, probe boolean, node long, component long, n long, "
          "signature binary")


def _pairs_across(members: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs between different components of a bucket that are likely linked."""
    hits = _cells(members, labels, classes, percent).groupBy(*_CELL).applyInArrow(_hits(percent), _CELLS)
    rows = hits.join(sets.mapInArrow(_prefixes, "node long, prefixes binary"), "node")
    return rows.groupBy(*_CELL).applyInArrow(_across(percent), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, words: int = 2, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their
    shingle sets; component_id is the smallest id reachable over links. A text
    that is null or has no words has an empty set and no links. A row without an id is
    linked like any other and is kept only if no linked row has an id; component_id is then
    null. Rows that repeat an id share its component if their texts are linked, and are kept
    together; rows with one id and unlinked texts are told apart. A text's set is held whole by a
    task. Extra columns are ignored; an empty table gives no rows.

    At 32 bands of 4 slots a pair at the threshold is missed with a probability of
    5e-8, a closer pair less. Pairs whose signatures agree in less than the percentage less
    ``MARGIN`` are not compared, which misses about one in a million at the threshold.
    """
    return _resolved(docs, words, percent).drop("mark")


def _resolved(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``near_duplicates`` with the mark of each row's text."""
    signed = doc_bytes(docs, text_mark()).mapInArrow(_sign(words), "doc_id long, n long, k1 long, k2 long, signature binary, mark long")
    signed = stored(signed.withColumn("row", F.monotonically_increasing_id()), "signatures")
    present = signed.filter("n > 0")
    classes = present.groupBy("k1", "k2").agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id"))
    classes = stored(classes.join(present.select("row", "n", "signature", F.col("doc_id").alias("node_id"), F.col("mark").alias("node_mark")), F.col("node") == F.col("row")).drop("row"),
                     "shingle-classes")
    bands = classes.select("node", "n", "signature").mapInArrow(_bands, "band long, node long, n long")
    sizes = bands.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    crowd = stored(bands.join(sizes, "band"), "buckets")
    # a bucket's pivot is the member with the most others over all its buckets: of a group of near copies, one like most of them
    company = crowd.groupBy("node").agg(F.sum("size").alias("company"))
    first = F.struct("company", -F.col("node"))
    pivots = crowd.join(company, "node").groupBy("band").agg(F.max_by("node", first).alias("pivot"), F.max_by("n", first).alias("pivot_n"))
    members = stored(crowd.drop("size").join(pivots, "band"), "pivots")
    near_enough = "100 * least(n, pivot_n) >= {0} * greatest(n, pivot_n)".format(int(percent))
    shared = members.filter(f"node <> pivot AND {near_enough}").groupBy("node", "pivot").agg(F.count("*").alias("shared"))
    likeliest = Window.partitionBy("node").orderBy(F.desc("shared"), "pivot")  # at most a row per band
    to_pivot = (shared.withColumn("rank", F.row_number().over(likeliest)).filter(F.col("rank") <= PIVOTS)
                .select(F.col("node").alias("u"), F.col("pivot").alias("v")))
    wanted = members.select("node").distinct().join(classes.select("node", "node_id", "node_mark", "k1", "k2"), "node")
    same = F.col("doc_id").eqNullSafe(F.col("node_id")) & (F.col("mark") == F.col("node_mark"))
    texts = doc_bytes(docs, text_mark()).join(wanted, same).select("node", "k1", "k2", "text")
    sets = stored(texts.mapInArrow(_sets(words), "node long, elements binary").dropDuplicates(["node"]), "shingle-sets")
    links = stored(confirmed(to_pivot, sets, percent), "links-to-pivots")
    first = stored(components(links), "first-components")
    across = stored(_pairs_across(members, first, classes, sets, percent), "pairs-across")
    more = confirmed(across, sets, percent)
    final = components(links.unionByName(more))
    ids = final.join(classes.select("node", "first_id"), "node")
    smallest = ids.groupBy("component").agg(F.min("first_id").alias("component_id"))
    reached = ids.join(smallest, "component").select("node", "component_id")
    resolved = classes.join(reached, "node", "left").select("k1", "k2", F.coalesce("component_id", "first_id").alias("component_id"))
    linked = present.select("doc_id", "n", "mark", "k1", "k2").join(resolved, ["k1", "k2"]).select("doc_id", "n", "mark", "component_id")
    alone = signed.filter("n = 0").select("doc_id", "n", "mark", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "mark")


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each group, with all their columns; each row by its own text."""
    return without(docs, _resolved(docs, words, percent).filter("NOT kept"))
