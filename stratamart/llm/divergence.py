"""Source divergence audit: term distributions of sources compared by three-dimensional cube partitioning.

Terms are counted per (lang, source) inside the tasks. Counts travel packed, one row per
task, language and term block; a term block is a range of the term's hash. The task that
merges a block knows the document frequency of its terms, drops the rare ones, numbers the kept ones
and writes one slice (places, counts) per source. So no row per term ever passes a join.

Sources are dealt over group blocks. Slices are replicated to the cells (group block, group
block, term block) that need them; a cell fills in what its terms have in no text of a
source, computes the partial divergences of its pairs, and partial sums are reduced along the
term axis. A cell is bounded by the sizes of the blocks, whatever the number of sources, terms or texts.

All arithmetic is exact: probabilities are integers of 1e-9, computed from whole numbers.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import packed, partitions_of, stored
from .pieces import pieces

LEAST_DOCS = 10
SCALE = 1_000_000_000
GROUP_BLOCK = 64
TERM_BLOCK_BYTES = 64_000_000  # bytes of text for each term block
TOP = 10
HELD = 600_000

# Terms are runs of letters A-Z, a-z and of anything beyond ASCII; in UTF-8 bytes, with A-Z lower-cased and all else a space.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PACKED = "lang string, t int, sources array<string>, terms binary, source binary, n binary, docs binary"
_BLOCK = "lang string, t int, source string, size int, total long, terms binary, places binary, counts binary"
_PARTIAL = "lang string, a string, b string, value long"
_TELLING = "lang string, source string, item string, value long"


def _counts(total: dict, docs: dict, blocks: int):
    """Packed counts of a task by (lang, term block)."""
    by_lang: dict[str, list[str]] = {}
    for lang, source in total:
        by_lang.setdefault(lang, []).append(source)
    rows: list[tuple] = []
    for lang, sources in by_lang.items():
        terms, source, n, seen = [], [], [], []
        for k, s in enumerate(sources):
            found = total[lang, s]
            terms += found
            n += found.values()
            known = docs[lang, s]
            seen += [known[t] for t in found]
            source.append(np.full(len(found), k, np.int32))
        block = np.array([zlib.crc32(t) % blocks for t in terms], np.int64)
        order = np.argsort(block, kind="stable")
        source, n, seen = np.concatenate(source)[order], np.array(n, np.int64)[order], np.array(seen, np.int64)[order]
        edge = np.flatnonzero(np.diff(block[order], prepend=-1))
        for lo, hi in zip(edge.tolist(), np.append(edge[1:], len(order)).tolist()):
            rows.append((lang, int(block[order[lo]]), sources, b" ".join([terms[i] for i in order[lo:hi].tolist()]),
                         packed(source[lo:hi]), packed(n[lo:hi]), packed(seen[lo:hi])))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.list_(pa.string()), *[pa.binary()] * 4))],
        names=["lang", "t", "sources", "terms", "source", "n", "docs"])


def _count(blocks: int, held: int):
    def run(batches):
        total: dict = {}
        docs: dict = {}
        size = 0
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                group, seen = (lang, source), set()
                count = total.setdefault(group, Counter())
                before = len(count)
                for piece in pieces(text.as_py()):
                    terms = piece.translate(_TERMS).split()
                    count.update(terms)
                    seen.update(terms)
                docs.setdefault(group, Counter()).update(seen)
                size += len(count) - before
                if size > held:
                    yield _counts(total, docs, blocks)
                    total, docs, size = {}, {}, 0
        if total:
            yield _counts(total, docs, blocks)
    return run


def _merge(least_docs: int):
    """All packed counts of one (lang, term block) to one row of its kept terms and a slice per source."""
    def run(key, table):
        lang, t = key[0].as_py(), key[1].as_py()
        names: dict[str, int] = {}
        terms, source, n, docs = [], [], [], []
        for row in table.to_batches():
            for sources, packed_terms, s, count, seen in zip(*(row.column(c).to_pylist() for c in ("sources", "terms", "source", "n", "docs"))):
                code = np.array([names.setdefault(x, len(names)) for x in sources], np.int64)
                terms += packed_terms.split(b" ")
                source.append(code[np.frombuffer(s, np.int32)])
                n.append(np.frombuffer(count, np.int64))
                docs.append(np.frombuffer(seen, np.int64))
        coded = pa.array(terms, pa.binary()).dictionary_encode()
        term, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        source, n, docs = np.concatenate(source), np.concatenate(n), np.concatenate(docs)
        df = np.zeros(len(words), np.int64)
        np.add.at(df, term, docs)
        kept = np.flatnonzero(df >= least_docs)
        kept = kept[np.argsort(np.array([words[i].as_py() for i in kept.tolist()], object), kind="stable")] if len(kept) else kept
        place = np.full(len(words), -1, np.int64)
        place[kept] = np.arange(len(kept))
        use = place[term] >= 0
        cell, at = np.unique(source[use] * max(1, len(kept)) + place[term[use]], return_inverse=True)
        count = np.zeros(len(cell), np.int64)
        np.add.at(count, at, n[use])
        owner, where = np.divmod(cell, max(1, len(kept)))
        whole = np.zeros(len(kept), np.int64)
        np.add.at(whole, where, count)
        rows = [(lang, t, None, len(kept), int(whole.sum()), b" ".join(words[i].as_py() for i in kept.tolist()), None, packed(whole))]
        for name, k in names.items():
            lo, hi = np.searchsorted(owner, (k, k + 1))
            if hi > lo:
                rows.append((lang, t, name, len(kept), int(count[lo:hi].sum()), None, packed(where[lo:hi].astype(np.int32)), packed(count[lo:hi])))
        return pa.table([pa.array([r[i] for r in rows], x) for i, x in enumerate(
            (pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
            names=["lang", "t", "source", "size", "total", "terms", "places", "counts"])
    return run


def term_blocks(docs: DataFrame, least_docs: int = LEAST_DOCS, blocks: int | None = None, held: int = HELD) -> DataFrame:
    """Per (lang, term block): a row with the kept terms and their counts (source null), and a slice per source."""
    rows = _texts(docs)
    if blocks is None:
        total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        blocks = max(partitions_of(docs.sparkSession), -(-total // TERM_BLOCK_BYTES))
    return rows.mapInArrow(_count(blocks, held), _PACKED).groupBy("lang", "t").applyInArrow(_merge(least_docs), _BLOCK)


def _texts(docs: DataFrame) -> DataFrame:
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))


def probabilities(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(1e9 * (count + 2) / (total + 2 * terms)) of whole numbers of any size."""
    if total < 9_000_000_000:
        return 1 + SCALE * (count + 2) // (total + 2 * terms)
    return np.array([1 + SCALE * (int(c) + 2) // (total + 2 * terms) for c in count], np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of integers."""
    return (p - q) ** 2 // (p + q)


def _cell(key, table):
    """Partial sums of one cell: each pair of the two group blocks once, over the terms of the block."""
    low, high = key[1].as_py(), key[2].as_py()
    rows = table.to_pylist()
    size = max(r["size"] for r in rows)
    dense = np.empty((len(rows), size), np.int64)
    for k, r in enumerate(rows):
        if size:
            dense[k] = probabilities(np.zeros(1, np.int64), r["total"], r["kept"])[0]
            if r["places"] is not None:
                dense[k, np.frombuffer(r["places"], np.int32)] = probabilities(np.frombuffer(r["counts"], np.int64), r["total"], r["kept"])
    a, b, value = [], [], []
    for k, r in enumerate(rows):
        if r["block"] != low:
            continue
        for x, other in enumerate(rows):
            if other["block"] == high and (low != high or other["source"] > r["source"]):
                a.append(r["source"])
                b.append(other["source"])
                value.append(int(divergence(dense[k], dense[x]).sum()))
    return pa.table({"lang": pa.array([key[0].as_py()] * len(a), pa.string()), "a": pa.array(a, pa.string()),
                     "b": pa.array(b, pa.string()), "value": pa.array(value, pa.int64())})


def _telling(top: int):
    """The terms of one block that a source has most above its language, at most ``top`` a source."""
    def run(key, table):
        rows = table.to_pylist()
        block = next((r for r in rows if r["source"] is None), None)
        out: list[tuple] = []
        if block is not None and block["size"]:
            terms = block["terms"].split(b" ")
            q = probabilities(np.frombuffer(block["counts"], np.int64), block["total"], block["kept"])
            for r in rows:
                if r["source"] is None:
                    continue
                places = np.frombuffer(r["places"], np.int32)
                p = probabilities(np.frombuffer(r["counts"], np.int64), r["total"], r["kept"])
                value = divergence(p, q[places])
                over = np.flatnonzero(p > q[places])
                best = over[np.lexsort((places[over], -value[over]))][:top]  # places are in the order of the terms' bytes
                out += [(r["lang"], r["source"], terms[places[i]].decode(), int(value[i])) for i in best.tolist()]
        return pa.table([pa.array([r[i] for r in out], x) for i, x in enumerate((pa.string(), pa.string(), pa.string(), pa.int64()))],
                        names=["lang", "source", "item", "value"])
    return run


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, group_block: int = GROUP_BLOCK,
          blocks: int | None = None) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): divergence of each source from the others, and its telling terms.

    Null text, lang and source are empty strings, and such groups count like any other. Every
    row is a document, repeated or not; a null id does not matter. Ties go by the item's
    bytes. Texts are read in pieces, so their length does not matter. A language without kept
    terms gives pairs of value 0. An empty table gives no rows; other columns are ignored.
    """
    found = stored(term_blocks(docs, least_docs, blocks), "term-blocks")
    terms, slices = found.filter("source is null"), found.filter("source is not null")
    sizes = terms.groupBy("lang").agg(F.sum("size").alias("kept"), F.sum("total").alias("lang_total"))
    groups = _texts(docs).select("lang", "source").distinct()
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(sizes, "lang", "left")
    totals = slices.groupBy("lang", "source").agg(F.sum("total").alias("total"))
    many = F.greatest(F.lit(1), F.ceil(F.col("sources") / group_block)).cast("int")
    known = stored(groups.join(totals, ["lang", "source"], "left").join(langs, "lang").select(
        "lang", "source", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("total", F.lit(0)).alias("total"),
        many.alias("group_blocks"), F.pmod(F.xxhash64("source"), many).cast("int").alias("block")), "groups")

    places = slices.select("lang", "source", "t", "places", "counts")
    in_use = terms.filter("size > 0").select("lang", "t", "size")
    every = known.filter("kept > 0").join(in_use, "lang").join(places, ["lang", "source", "t"], "left").unionByName(
        known.filter("kept = 0").withColumns({"t": F.lit(0), "size": F.lit(0)}), allowMissingColumns=True)
    cells = (every.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)))
             .select("lang", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "t",
                     "source", "block", "kept", "total", "size", "places", "counts"))
    partial = cells.groupBy("lang", "low", "high", "t").applyInArrow(_cell, _PARTIAL)
    sums = stored(partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "divergences")
    pair = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))

    of_sources = places.join(known.select("lang", "source", "kept", "total"), ["lang", "source"]).withColumns(
        {"size": F.lit(None).cast("int"), "terms": F.lit(None).cast("binary")})
    of_langs = terms.drop("total", "places").join(sizes, "lang").withColumnRenamed("lang_total", "total")
    shown = ["lang", "t", "source", "kept", "total", "size", "terms", "places", "counts"]
    telling = of_sources.select(shown).unionByName(of_langs.withColumn("places", F.lit(None).cast("binary")).select(shown))
    best = telling.groupBy("lang", "t").applyInArrow(_telling(top), _TELLING)

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(df: DataFrame, part: str) -> DataFrame:
        return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pair, "pair").unionByName(ranked(best, "term").filter(F.col("rank") <= top))
