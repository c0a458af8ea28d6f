"""Near-duplicate documents with SetSketch registers.

A document's set holds its distinct word shingles. Each of M registers keeps
the smallest of the exponential values that a register's hash gives the set's
elements, on a logarithmic scale with base B and truncated to 0..Q+1
(Ertl, "SetSketch: filling the gap between MinHash and HyperLogLog", 2021).
Registers merge by maximum and equal registers are about as likely as the
sets' Jaccard similarity, so bands of registers find candidates.

1. Rows with the same set become one node, the smallest doc_id.
2. Nodes that agree in all registers of a band share a bucket. Each is paired
   with the bucket's hub only, the node whose buckets are largest in total:
   buckets give rows, not pairs, however large they are.
3. The joint maximum-likelihood estimate of the similarity, from the register
   comparison and both set sizes, drops pairs that are ESTIMATE_MARGIN below
   the threshold (more than five standard errors).
4. Remaining pairs are confirmed on their full sets; first each node's best
   pair, then pairs whose ends are still apart.
5. Hubs whose nodes still lie in several components are finished exactly: the
   nodes outside the hub's largest component are compared with all its nodes,
   in blocks of bounded size that are dealt over tasks and count common
   elements with a matrix product. Only links between components come out;
   nothing is capped.

With M registers in bands of r, a pair at the threshold t shares no band with
probability (1 - t^r)^(M / r); r is the largest for which that is below
MISSES (r = 6 for 0.85, 5 for 0.8: 3e-7 both). More similar pairs miss less.

Defined results: white space is ASCII; A-Z are lower-cased; a text with fewer
words than a shingle is one element; null, empty and blank texts have the
empty set and link with nothing; repeated rows share one set; different texts
under one doc_id count as one document; rows with a null doc_id are left alone (component null); an empty table gives no rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import (LOWER, bounded_batches, chain, mix64, quoted, staged, text_bytes, word_hashes,
                                  word_spans)

#: SetSketch parameters: base, rate and truncation of the registers (two bytes each).
B, A, Q = 1.001, 20.0, 2 ** 16 - 2
#: Registers, and how often a pair at the threshold may share no band.
M, MISSES = 192, 1e-6
ESTIMATE_MARGIN = 0.14
#: Candidate ids are broadcast to the text scan up to this count (16 MB of ids), else joined by shuffle.
BROADCAST_IDS = 2_000_000
#: Rows of a block of step 5: nodes that look for links, and nodes they are compared with.
PROBES, MEMBERS = 512, 4096
SEED = 5


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, end to end, and each text's offset."""
    raw, offsets = text_bytes(column)
    raw = LOWER[raw]
    starts, ends, first = word_spans(raw, offsets)
    w = word_hashes(raw, starts, ends)
    count = np.diff(first)
    wide = chain(*[w[i:len(w) - width + 1 + i] for i in range(width)]) if len(w) >= width else w[:0]
    sets, at = [], [0]
    for f, n in zip(first[:-1].tolist(), count.tolist()):
        if n >= width:
            s = np.unique(wide[f:f + n - width + 1])
        elif n:
            s = chain(*[w[f + i:f + i + 1] for i in range(n)])
        else:
            s = w[:0]
        sets.append(s)
        at.append(at[-1] + len(s))
    return (np.concatenate(sets) if sets else w[:0]), np.asarray(at)


def banding(percent: int, m: int = M) -> tuple[int, int]:
    """(registers per band, bands) for a similarity threshold in percent."""
    t = percent / 100
    r = max([1, *(r for r in range(1, m + 1) if (1 - t ** r) ** (m // r) <= MISSES)])
    return r, m // r


def _register_factors(m: int) -> np.ndarray:
    return mix64(np.arange(1, m + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED)) | np.uint64(1)


def registers(sets: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    """SetSketch registers (uint16, one row per non-empty set; empty sets are all 0)."""
    out = np.zeros((len(at) - 1, m), np.uint16)
    full = np.flatnonzero(np.diff(at))
    if not len(full):
        return out
    heads = at[:-1][full]
    low = np.empty((m, len(full)), np.uint64)
    for j, factor in enumerate(_register_factors(m)):
        low[j] = np.minimum.reduceat((sets * factor), heads)
    # the smallest uniform hash value gives the smallest exponential value
    u = (low.T.astype(np.float64) + 0.5) / 2.0 ** 64
    x = -np.log1p(-u) / A
    out[full] = np.clip(np.floor(1.0 - np.log(x) / np.log(B)), 0, Q + 1).astype(np.uint16)
    return out


def _sketch(batches, width: int, m: int):
    for batch in batches:
        sets, at = shingle_sets(batch.column(1), width)
        regs = registers(sets, at, m)
        n = np.diff(at)
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(x), dtype=np.uint64)])
                for x in (sets, sets ^ np.uint64(0xA5A5A5A5A5A5A5A5))]
        s1, s2 = (pa.array((c[at[1:]] - c[at[:-1]]).view(np.int64)) for c in sums)
        blob = regs.astype(">u2").tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), s1, s2,
             pa.array([blob[i * 2 * m:(i + 1) * 2 * m] for i in range(len(n))], pa.binary())],
            names=["doc_id", "n_shingles", "s1", "s2", "regs"])


def _set_rows(batches, width: int):
    for batch in batches:
        sets, at = shingle_sets(batch.column(1), width)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()),
             pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), pa.array(sets.view(np.int64))).cast(pa.list_(pa.int64()))],
            names=["id", "items"])


def joint_estimate(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs from their registers
    (rows of equal length) and exact set sizes; concave, found by ternary search."""
    up, down = (ra > rb).sum(1), (ra < rb).sum(1)
    same = ra.shape[1] - up - down
    u, v = na / (na + nb), nb / (na + nb)

    def p(x):
        return -np.log1p(-np.clip(x, 0.0, 1.0) * (B - 1) / B) / np.log(B)

    def loglik(j):
        a, b = p(u - v * j), p(v - u * j)
        with np.errstate(divide="ignore", invalid="ignore"):
            parts = (up * np.log(a), down * np.log(b), same * np.log(np.maximum(1 - a - b, 0)))
        return sum(np.where(k == 0, 0.0, x) for k, x in zip((up, down, same), parts))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        left, right = low + (high - low) / 3, high - (high - low) / 3
        better = loglik(left) < loglik(right)
        low, high = np.where(better, left, low), np.where(better, high, right)
    return (low + high) / 2


def _likely(batches, least: float):
    for batch in batches:
        if not batch.num_rows:
            continue
        ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u2").reshape(batch.num_rows, -1)
                  for c in ("ra", "rb"))
        na, nb = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("na", "nb"))
        keep = pa.array(joint_estimate(ra, rb, na, nb) >= least)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph given as rows (a, b): smallest
    reachable node, by alternating large-star and small-star rounds, each
    written to the shared folder. Nodes are those of the edges."""
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))

    def state(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]
    last = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        mins = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(mins, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = staged(small.union(mins.select("u", F.col("m").alias("v"))).distinct())
        new = state(now)
        if new == last:
            break
        last = new
    return now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")


class _Search:
    """Sketches and shared tables of one search over ``docs`` (doc_id, text)."""

    def __init__(self, docs: DataFrame, width: int, percent: int):
        bounded_batches(docs.sparkSession)
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        self.width, self.percent = width, percent
        self.rows = staged(self.docs.mapInArrow(
            partial(_sketch, width=width, m=M),
            "doc_id long, n_shingles long, s1 long, s2 long, regs binary"))
        solid = self.rows.where("n_shingles > 0 and doc_id is not null")
        self.nodes = staged(solid.groupBy("n_shingles", "s1", "s2").agg(
            F.min("doc_id").alias("id"), F.min_by("regs", "doc_id").alias("regs")))

    def bands(self) -> DataFrame:
        """(key, id): one row per node and band."""
        r, n = banding(self.percent)
        keys = F.array(*[F.xxhash64(F.lit(b), F.substring("regs", 2 * r * b + 1, 2 * r)) for b in range(n)])
        return self.nodes.select("id", F.explode(keys).alias("key"))

    def likely(self, pairs: DataFrame) -> DataFrame:
        side = self.nodes.select("id", "n_shingles", "regs")
        a = side.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("regs").alias("ra"))
        b = side.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("regs").alias("rb"))
        fits = f"100 * least(na, nb) >= {self.percent} * greatest(na, nb)"
        return (pairs.join(a, "a").join(b, "b").where(fits)
                .mapInArrow(partial(_likely, least=self.percent / 100 - ESTIMATE_MARGIN), "a long, b long"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that meet the threshold on their full sets."""
        pairs = staged(self.likely(pairs))
        need = staged(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
        ids = F.broadcast(need) if need.count() <= BROADCAST_IDS else need
        texts = self.docs.join(ids, "doc_id", "left_semi")
        sets = staged(texts.mapInArrow(partial(_set_rows, width=self.width), "id long, items array<bigint>"))
        a = sets.select(F.col("id").alias("a"), F.col("items").alias("ia"))
        b = sets.select(F.col("id").alias("b"), F.col("items").alias("ib"))
        both = F.size(F.array_intersect("ia", "ib")).cast("long")
        return staged(pairs.join(a, "a").join(b, "b")
                      .where(100 * both >= self.percent * (F.size("ia") + F.size("ib") - both))
                      .select("a", "b").distinct())


def _labels(nodes: DataFrame, parts: DataFrame, col: str = "component") -> DataFrame:
    """Replace ``col`` of ``nodes`` by the component its value belongs to, if any."""
    p = parts.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    return (nodes.join(p, F.col(col) == F.col("_n"), "left")
            .withColumn(col, F.coalesce("_c", col)).drop("_n", "_c"))


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components, with both components."""
    a = label.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    b = label.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    return pairs.join(a, "a").join(b, "b").where("ca <> cb")


def near_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``; links are
    pairs with 100 * intersection >= percent * union."""
    s = _Search(docs, width, percent)
    bands = staged(_multi(s.bands()))
    score = bands.groupBy("id").agg(F.sum("n").alias("score"))
    scored = bands.join(score, "id")
    hubs = scored.groupBy("key").agg(F.max_by("id", F.struct("score", -F.col("id"))).alias("b"))
    pairs = staged(bands.join(hubs, "key").where("id <> b").groupBy(F.col("id").alias("a"), "b")
                   .agg(F.count(F.lit(1)).alias("n")))
    label = s.nodes.select("id", F.col("id").alias("component")).distinct()

    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("b"))
    label = staged(_labels(label, components(s.confirmed(best))))
    rest = _apart(pairs.join(best, ["a", "b"], "left_anti").select("a", "b"), label).select("a", "b")
    links = _apart(s.confirmed(rest), label).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    label = staged(_labels(label, components(links)))
    label = staged(_labels(label, components(_block_links(s, pairs, label))))

    sets = s.nodes.select("n_shingles", "s1", "s2", "id").join(label, "id").drop("id")
    return (s.rows.select("doc_id", "n_shingles", "s1", "s2")
            .join(sets, ["n_shingles", "s1", "s2"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))


def _multi(bands: DataFrame) -> DataFrame:
    """(key, id, n): band rows of buckets with n >= 2 nodes."""
    many = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return bands.join(many, "key")


def _block_links(s: _Search, pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Links (a, b) between components of nodes that share a hub. All pairs with
    the hub itself are decided already, so a hub counts if its other nodes lie
    in several components."""
    nodes = pairs.select(F.col("b").alias("hub"), F.col("a").alias("id")).join(label, "id")
    per = nodes.groupBy("hub", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = per.groupBy("hub").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("k"), F.max("n").alias("most"),
                                   F.max_by("component", F.struct("n", "component")).alias("main")).where("parts > 1")
    blocks = mixed.select("hub", "main", F.ceil(F.col("k") / MEMBERS).alias("kb"),
                          F.ceil((F.col("k") - F.col("most")) / PROBES).alias("tb"))
    open_ = staged(nodes.join(blocks, "hub"))
    need = staged(open_.select(F.col("id").alias("doc_id")).distinct())
    ids = F.broadcast(need) if need.count() <= BROADCAST_IDS else need
    sets = staged(s.docs.join(ids, "doc_id", "left_semi").mapInArrow(
        partial(_set_rows, width=s.width), "id long, items array<bigint>"))
    h = F.xxhash64("id")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    probes = open_.where("component <> main").select(
        "hub", "id", "component", F.lit(True).alias("probe"), F.pmod(h, F.col("tb")).alias("i"), every("kb").alias("j"))
    members = open_.select("hub", "id", "component", F.lit(False).alias("probe"), every("tb").alias("i"),
                           F.pmod(h, F.col("kb")).alias("j"))
    return (probes.union(members).join(sets, "id").groupBy("hub", "i", "j")
            .applyInArrow(_block(s.percent), "a long, b long").distinct())


def _block(percent: int):
    def run(table: pa.Table) -> pa.Table:
        return linked_components(table, percent)
    return run


def linked_components(table: pa.Table, percent: int) -> pa.Table:
    """Component pairs (a, b) linked between probes and members of one block,
    counted exactly: frequent elements by matrix product, the others by their rows."""
    probe = table.column("probe").to_numpy(zero_copy_only=False).astype(bool)
    comp = table.column("component").to_numpy()
    flat = table.column("items").combine_chunks()
    offsets, values = flat.offsets.to_numpy(), flat.values.to_numpy()
    size = np.diff(offsets)
    _, code = np.unique(values[offsets[0]:offsets[-1]], return_inverse=True)
    row = np.repeat(np.arange(len(size)), size)
    p, m = np.flatnonzero(probe), np.flatnonzero(~probe)
    at = np.empty(len(size), np.int64)
    at[p], at[m] = np.arange(len(p)), np.arange(len(m))
    common = np.zeros((len(p), len(m)), np.float32)
    of_probe = probe[row]
    pc, pr, mc, mr = code[of_probe], at[row[of_probe]], code[~of_probe], at[row[~of_probe]]
    total = int(code.max()) + 1 if len(code) else 0
    df, pf = np.bincount(mc, minlength=total), np.bincount(pc, minlength=total)
    both = (df > 0) & (pf > 0)
    often = np.flatnonzero(both & (df * pf > 4096))
    slot = np.full(total, -1)
    for i in range(0, len(often), 1024):
        part = often[i:i + 1024]
        slot[:] = -1
        slot[part] = np.arange(len(part))
        x, y = np.zeros((len(p), len(part)), np.float32), np.zeros((len(m), len(part)), np.float32)
        k = slot[pc] >= 0
        x[pr[k], slot[pc[k]]] = 1
        k = slot[mc] >= 0
        y[mr[k], slot[mc[k]]] = 1
        common += x @ y.T
    seldom = both.copy()
    seldom[often] = False
    k = seldom[mc]
    order = np.argsort(mc[k], kind="stable")
    mc, mr = mc[k][order], mr[k][order]
    k = seldom[pc]
    pc, pr = pc[k], pr[k]
    lo, n = np.searchsorted(mc, pc, "left"), df[pc]
    for i in range(0, len(pc), 65536):
        c = n[i:i + 65536]
        first = np.repeat(lo[i:i + 65536] - np.concatenate([[0], np.cumsum(c)[:-1]]), c)
        np.add.at(common, (np.repeat(pr[i:i + 65536], c), mr[first + np.arange(len(first))]), 1)
    sizes = size[p][:, None] + size[m][None, :]
    a, b = np.nonzero((100 * common >= percent * (sizes - common)) & (comp[p][:, None] != comp[m][None, :]))
    pairs = np.unique(np.stack([comp[p][a], comp[m][b]], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})


def deduplicate(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The input's columns, one row of each component (its smallest doc_id);
    rows without a doc_id and rows with the empty set stay."""
    keep = (near_components(docs, width, percent)
            .where("component_id = doc_id").select(F.col("doc_id").alias("_keep")).distinct())
    rec = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("rec"))
    kept = rec.join(keep, F.col("rec.doc_id").cast("long") == F.col("_keep"), "left_semi")
    return kept.union(rec.where(F.col("rec.doc_id").isNull())).select("rec.*")
