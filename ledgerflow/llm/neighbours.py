"""Near-duplicate vectors: flat graph on overlapping cluster shards, range search, exact check.

1. Rows become unit vectors in double precision; equal vectors collapse into one with its copies counted.
2. Shard centres: k-means on a bounded sample, split further wherever the sample says a cluster is too large.
   Every vector is a member of the shards of its ``overlap`` nearest centres, and asks in the ``probes``
   nearest ones and in every tight cluster that could hold a vector in range.
3. Each shard builds a robust-pruned graph over its members; the adjacency lists of a vector from its shards
   are united, and each shard is searched with the united lists as far as they lead to its members.
4. Greedy search from the vector's own node, the shard's medoid, fixed members and a member of every connected
   part expands over the whole range.  Hits are checked by the exact cosine.  Where the links that a vector
   finds in a shard aren't those that find it from there, the two are compared in full, so that a link counts
   for both of its ends.  A spanning forest of each task's links goes to the components.
5. Recall is audited against brute force for a sample of vectors that have links: the mean over the vectors,
   of those with few, more and many links each.  While one of these is below the aim, beam and probes are
   doubled; where all shards are probed and the aim is still missed, the shards' members are compared with
   all vectors in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage
from .common import groups, hash_share, rows_of, table
from .components import connected
from .vector_graph import build, medoid, parts, search


#: Times the audited vectors asked for that are drawn at most.
AUDIT_MOST = 10


def unit_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double> of length 1, or null where nothing can link)."""
    v = F.transform(qcol(vec_col), lambda x: x.cast("double"))
    # scaled by the largest component first, so that squares neither overflow nor vanish
    top = F.array_max(F.transform(v, F.abs))
    finite = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & (top > 0)
    scaled = F.transform(v, lambda x: x / top)
    norm = F.sqrt(F.aggregate(F.col("s"), F.lit(0.0), lambda a, x: a + x * x))
    return (df.select(qcol(id_col).cast("long").alias("vec_id"), F.when(F.coalesce(finite, F.lit(False)), scaled).alias("s"))
            .select("vec_id", F.when(F.col("s").isNotNull(), F.transform("s", lambda x: x / norm)).alias("v")))


def centres(sample: np.ndarray, share: float, max_shard: int, seed: int = 0) -> np.ndarray:
    """Centres from a sample of ``share`` of the vectors so that shards have about ``max_shard`` / 2 members, as far as the sample can tell."""
    rng = np.random.default_rng(seed)

    def split(x: np.ndarray, depth: int) -> list[np.ndarray]:
        k = min(64, len(x) // 4, math.ceil(len(x) / share / (max_shard / 2)))
        if k < 2 or depth > 8:
            return [x.mean(axis=0)]
        c = x[rng.choice(len(x), k, replace=False)]
        for _ in range(8):
            own = (x @ c.T).argmax(axis=1)
            c = np.stack([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(k)])
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = (x @ c.T).argmax(axis=1)
        if len(np.unique(own)) < 2:
            return [x.mean(axis=0)]
        return [y for i in np.unique(own) for y in (split(x[own == i], depth + 1) if (own == i).sum() / share > max_shard else [c[i]])]

    got = np.stack(split(sample, 0)) if len(sample) else np.zeros((0, sample.shape[1] if sample.ndim == 2 else 1))
    return got / np.maximum(np.linalg.norm(got, axis=1, keepdims=True), 1e-12)


def _shared(spark, **x):
    return spark.sparkContext.broadcast(x)


def _memberships(vecs: DataFrame, centre: np.ndarray, overlap: int) -> DataFrame:
    """(shard, rank, rep, v, copies, angle): every vector in the shards of its ``overlap`` nearest centres, nearest first."""
    shared = _shared(vecs.sparkSession, c=centre)
    arrow = pa.schema([("shard", pa.int32()), ("rank", pa.int32()), ("rep", pa.int64()), ("v", pa.list_(pa.float64())), ("copies", pa.int64()), ("angle", pa.float64())])

    def run(batches):
        c = shared.value["c"]
        k = min(overlap, len(c))
        for b in batches:
            if not b.num_rows:
                continue
            v = np.array(b.column(1).flatten().to_numpy()).reshape(b.num_rows, -1)
            sim = v @ c.T
            near = np.argsort(-sim, axis=1, kind="stable")[:, :k]
            flat, rows = near.ravel(), np.repeat(np.arange(len(v)), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat.astype(np.int32)), pa.array(np.tile(np.arange(k, dtype=np.int32), len(v))), b.column(0).take(pa.array(rows)),
                 b.column(1).take(pa.array(rows)), b.column(2).take(pa.array(rows)), pa.array(np.arccos(np.clip(sim[rows, flat], -1, 1)))], schema=arrow)

    return vecs.select("rep", "v", "copies").mapInArrow(run, "shard int, rank int, rep long, v array<double>, copies long, angle double")


def _adjacency(members: DataFrame, degree: int) -> DataFrame:
    """(rep, nbs): united out-neighbours of every vector over its shards, reverse edges of its shard included."""
    arrow = pa.schema([("rep", pa.int64()), ("nbs", pa.list_(pa.int64()))])

    def run(batches):
        for _, rows in groups(batches, 1):
            reps = np.array([r[0] for r in rows], np.int64)
            g = build(np.array([r[1] for r in rows]), degree)
            src = np.repeat(np.arange(len(g)), g.shape[1])[g.ravel() >= 0]
            dst = g.ravel()[g.ravel() >= 0]
            a, b = np.concatenate([src, dst]), np.concatenate([dst, src])
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            ends = np.searchsorted(a, np.arange(len(g) + 1))
            yield table([(int(reps[i]), np.unique(reps[b[ends[i]:ends[i + 1]]])) for i in range(len(g))], arrow)

    lists = members.select("shard", "rep", "v").repartition("shard").sortWithinPartitions("shard", "rep").mapInArrow(run, "rep long, nbs array<long>")
    return lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("nbs"))).alias("nbs"))


def _ask(members: DataFrame, centre: np.ndarray, tight: dict[int, float], probes: int, least: float) -> DataFrame:
    """(shard, rep, v, home): every vector asks in its nearest shards and in tight ones that its range may reach; ``home`` is its own."""
    reach = math.acos(min(1.0, least))
    radius = np.full(len(centre), -1.0)
    for s, r in tight.items():
        radius[s] = r
    shared = _shared(members.sparkSession, c=centre, r=radius)
    arrow = pa.schema([("shard", pa.int32()), ("rep", pa.int64()), ("v", pa.list_(pa.float64())), ("home", pa.int32())])

    def run(batches):
        c, r = shared.value["c"], shared.value["r"]
        k = min(probes, len(c))
        for b in batches:
            if not b.num_rows:
                continue
            v = np.array(b.column(1).flatten().to_numpy()).reshape(b.num_rows, -1)
            sim = v @ c.T
            pick = np.zeros(sim.shape, bool)
            np.put_along_axis(pick, np.argsort(-sim, axis=1, kind="stable")[:, :k], True, 1)
            pick |= (r >= 0) & (np.arccos(np.clip(sim, -1, 1)) <= r + reach)
            rows, shard = np.nonzero(pick)
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), b.column(0).take(at), b.column(1).take(at), b.column(2).take(at)], schema=arrow)

    return members.where("rank = 0").select("rep", "v", "shard").mapInArrow(run, "shard int, rep long, v array<double>, home int")


def _compare(x: np.ndarray, q: np.ndarray, least: float, step: int = 4096) -> list[np.ndarray]:
    """Per row of ``q``, the positions in ``x`` whose similarity is ``least`` or more, by comparing all in blocks."""
    out: list[list[np.ndarray]] = [[] for _ in q]
    for at in range(0, len(x), step):
        i, j = np.nonzero(q @ x[at:at + step].T >= least)
        for k, part in enumerate(np.split(j + at, np.searchsorted(i, np.arange(1, len(q))))):
            out[k].append(part)
    return [np.concatenate(o) for o in out]


def _mixed(ids: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every id."""
    h = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))).view(np.int64)


def _hits(members: DataFrame, adjacency: DataFrame | None, asks: DataFrame, least: float, beam: int | None, starts: int = 8, block: int = 256) -> DataFrame:
    """(finds, shard, rep, n, copies, digest, other): in every shard, for every vector that asks there, its links to the shard's own members.

    A vector that is a member of several shards counts in the one of its nearest centre only, so no link
    is found twice; the others lend it as a stepping stone.  Rows with ``finds`` tell what vector ``rep`` found
    in ``shard`` (``n`` vectors, ``copies`` rows), those without how many vectors of home ``shard`` found ``rep``;
    ``digest`` is a hash of those.  Rows with null ``finds`` are a spanning forest of the links of each shard,
    edges from ``rep`` to ``other``; the links themselves stay in the task.
    Without a ``beam``, the asking vectors are compared with all own members, ``block`` of them at a time.
    """
    lent = members.join(adjacency, "rep") if beam is not None else members.where("rank = 0").withColumn("nbs", F.lit(None).cast("array<long>"))
    built = lent.select("shard", F.lit(0).alias("kind"), F.lit(-1).alias("home"), "rep", "v", (F.col("rank") == 0).alias("own"), "nbs", "copies")
    asked = asks.select("shard", F.lit(1).alias("kind"), "home", "rep", "v", F.lit(False).alias("own"), F.lit(None).cast("array<long>").alias("nbs"), F.lit(0).cast("long").alias("copies"))
    rows = built.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "kind", "home", "rep")
    arrow = pa.schema([("finds", pa.bool_()), ("shard", pa.int32()), ("rep", pa.int64()), ("n", pa.int64()),
                       ("copies", pa.int64()), ("digest", pa.int64()), ("other", pa.int64())])

    def run(batches):
        shard, home, member, ready, asking = None, None, [], None, []
        out = []

        def answer():
            reps, x, at, graph, first, mine, copies, tree, times, mark = ready
            q = np.array([v for _, v in asking])
            near = _compare(x, q, least - 1e-9) if beam is None else [
                search(x, graph, np.union1d(first, [at[r]]) if r in at else first, v, least - 1e-9, beam) for (r, _), v in zip(asking, q)]
            ids = _mixed(np.array([r for r, _ in asking], np.int64))
            for (rep, _), v, got, h in zip(asking, q, near, ids):
                got = got[mine[got] & (reps[got] != rep)]
                got = got[np.array([float(np.dot(x[g], v)) >= least for g in got], bool)]
                if len(got):
                    out.append((True, shard, rep, len(got), int(copies[got].sum()), int(np.bitwise_xor.reduce(_mixed(reps[got]))), None))
                    times[got] += 1
                    mark[got] ^= h
                    own = at.get(rep, -1)
                    known = own >= 0 and mine[own]
                    trees = np.unique(tree[np.append(got, own) if known else got])      # a tree is named by one of its members
                    if len(trees) > 1:
                        tree[np.isin(tree, trees)] = trees[0]
                    ends = reps[trees].tolist()
                    out.extend((None, shard, a, None, None, None, b) for a, b in zip(ends if known else [rep, *ends], ends[1:] if known else ends))
            asking.clear()

        def end():                                  # of the vectors of one home that ask in the shard
            if asking:
                answer()
            if ready is not None:
                reps, times, mark = ready[0], ready[-2], ready[-1]
                out.extend((False, home, int(reps[g]), int(times[g]), None, int(mark[g]), None) for g in np.flatnonzero(times))
                times[:], mark[:] = 0, 0

        for b in batches:
            for s, kind, h, rep, v, own, nbs, k in rows_of(b):
                if (s, h) != (shard, home):
                    end()
                    if s != shard:
                        member, ready = [], None
                    shard, home = s, h
                if kind == 0:
                    member.append((rep, v, own, nbs, k))
                    continue
                if ready is None and member:
                    reps = np.array([m[0] for m in member], np.int64)
                    x = np.array([m[1] for m in member])
                    at = {r: i for i, r in enumerate(reps.tolist())}
                    graph = first = None
                    if beam is not None:
                        graph = [np.array([at[y] for y in m[3] if y in at], np.int64) for m in member]
                        first = np.unique(np.concatenate([[medoid(x)], np.linspace(0, len(x) - 1, min(starts, len(x))).astype(int)]))
                        part = parts(graph)
                        lone = (np.flatnonzero(part == p) for p in np.setdiff1d(part, part[first]))
                        first = np.concatenate([first, np.array([g[medoid(x[g])] for g in lone], int)])
                    ready = (reps, x, at, graph, first, np.array([m[2] for m in member]), np.array([m[4] for m in member], np.int64),
                             np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x), np.int64))
                    member = []
                if ready is None:
                    continue
                asking.append((rep, v))
                if len(asking) >= block:
                    answer()
                if len(out) >= 512:
                    yield table(out, arrow)
                    out.clear()
        end()
        yield table(out, arrow)

    return rows.mapInArrow(run, "finds boolean, shard int, rep long, n long, copies long, digest long, other long")


def _both_ends(members: DataFrame, hits: DataFrame, least: float) -> DataFrame:
    """The rows of ``hits`` that tell what a vector found, such that every link is found from both of its ends, and the forests.

    Where what a vector found in a shard isn't what found it from there, it is compared with all own members;
    so is the other end of every link that only one of them found.
    """
    differ = cut_lineage(hits.where("finds is not null").groupBy("rep", "shard").agg(F.sum(F.when(F.col("finds"), F.col("n")).otherwise(-F.col("n"))).alias("d"), F.bit_xor("digest").alias("x"))
                         .where("d <> 0 or x <> 0").select("rep", "shard"))
    found = hits.where("coalesce(finds, true)")
    if not differ.limit(1).count():
        return found
    own = members.where("rank = 0").select("rep", "v", F.col("shard").alias("home"))
    again = _hits(members.join(differ.select("shard").distinct(), "shard", "left_semi"), None, differ.join(own, "rep"), least, None).where("coalesce(finds, true)")
    stale = differ.select("rep", "shard", F.lit(True).alias("finds"))              # the links of a forest hold
    return found.join(stale, ["rep", "shard", "finds"], "left_anti").unionByName(again)


def _brute(vecs: DataFrame, reps: np.ndarray, queries: np.ndarray, least: float) -> np.ndarray:
    """Number of links of every query vector, by comparing them with every vector."""
    shared = _shared(vecs.sparkSession, q=queries, r=reps)
    arrow = pa.schema([("q", pa.int32()), ("n", pa.int64())])

    def run(batches):
        q, r = shared.value["q"], shared.value["r"]
        n = np.zeros(len(q), np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                v = np.array(part.column(1).flatten().to_numpy()).reshape(part.num_rows, -1)
                n += ((q @ v.T >= least) & (r[:, None] != part.column(0).to_numpy()[None, :])).sum(axis=1)
        yield table(list(zip(np.flatnonzero(n), n[n > 0])), arrow)

    got = vecs.select("rep", "v").mapInArrow(run, "q int, n long").groupBy("q").agg(F.sum("n").alias("n")).toPandas()    # one row per query at most
    out = np.zeros(len(queries), np.int64)
    out[got["q"].to_numpy(int)] = got["n"].to_numpy(int)
    return out


def _audited(vecs: DataFrame, reps: np.ndarray, sample: np.ndarray, least: float, queries: int, most: int = AUDIT_MOST) -> dict[int, int]:
    """{rep: links} of sampled vectors that have links.

    ``queries`` vectors are drawn; while fewer than a quarter as many have few links, as many again as there are, up to ``most`` times ``queries``.
    """
    links = np.zeros(0, np.int64)
    while len(links) < min(len(sample), most * queries) and (not len(links) or (_size(links) == 1).sum() < queries / 4):
        at = slice(len(links), min(max(queries, 2 * len(links)), most * queries))
        links = np.concatenate([links, _brute(vecs, reps[at], sample[at], least)])
    return {int(r): int(n) for r, n in zip(reps, links) if n}


def _size(links: np.ndarray) -> np.ndarray:
    """Class of a number of links: none, few (to 8), more (to 64), many."""
    return np.searchsorted([0, 8, 64], links, "left")


def _recall(want: dict[int, int], got: dict[int, int]) -> float:
    """Mean share of found links over the audited vectors of a class, the lowest of the classes."""
    n = np.array(list(want.values()), np.int64)
    share = np.minimum([got.get(r, 0) for r in want], n) / np.maximum(n, 1)
    return min((float(share[_size(n) == k].mean()) for k in np.unique(_size(n))), default=1.0)


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.95, max_shard: int = 2000,
                 sample_rows: int = 20_000, overlap: int = 2, probes: int = 3, beam: int = 32, degree: int = 16,
                 audit_queries: int = 200, aim: float = 0.99) -> DataFrame:
    """vec_id, n_links, component_id and kept per row of ``df``; links are cosines of ``least`` or more.

    Null, empty or zero vectors and such with null or non-finite components link with nothing: no links, a
    component of their own.  Vectors of different lengths link with nothing either.  Equal vectors are one
    vector with copies: each copy links with the others and with all that the vector links with.  Rows with a
    null id count as links; they name no component.  A repeated id is one more row with that id.  The index is
    fitted on about ``sample_rows`` vectors at most (by hash of the row) and holds all; recall is audited with
    ``audit_queries`` other vectors or, where few of them have links, up to ten times as many.  Other columns are ignored, whatever their names.
    """
    rows = cut_lineage(unit_vectors(df, id_col, vec_col).withColumn("row", F.monotonically_increasing_id())
                       .withColumn("dims", F.size("v")).withColumn("hash", F.xxhash64("v")))
    distinct = cut_lineage(rows.where("v is not null").groupBy("dims", "v").agg(
        F.count("*").alias("copies"), F.min("row").alias("rep"), F.min("vec_id").alias("least_id")))
    dims = [r[0] for r in distinct.select("dims").distinct().collect()]      # one entry per vector length
    counted, edges = None, None
    for d in dims:
        c, e = _links(distinct.where(F.col("dims") == d), least, max_shard, sample_rows, overlap, probes, beam, degree, audit_queries, aim)
        counted, edges = (c, e) if counted is None else (counted.unionByName(c), edges.unionByName(e))
    own = F.lit(0).cast("long")
    if counted is None:
        return rows.select("vec_id", own.alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    roots = connected(edges)
    of = (distinct.join(roots, distinct.rep == roots.node, "left").select("rep", "dims", "v", "copies", "least_id", F.coalesce("root", "rep").alias("root")))
    names = of.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = of.join(names, "root").join(counted, "rep", "left").select(
        F.col("dims").alias("_d"), F.col("v").alias("_v"), "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = rows.join(classes, (rows["dims"] == classes["_d"]) & (rows["v"] == classes["_v"]), "left")
    component = F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", own).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _links(vecs, least, max_shard, sample_rows, overlap, probes, beam, degree, audit_queries, aim):
    """(rep, others: linked rows besides copies) and forest edges (a, b) of distinct vectors of one length."""
    n = vecs.count()
    picked = vecs.where(hash_share("rep", sample_rows, n)).select("rep", "v").toArrow()
    sample = np.array(picked.column(1).combine_chunks().flatten().to_numpy()).reshape(picked.num_rows, -1)
    centre = centres(sample, picked.num_rows / max(n, 1), max_shard)
    members = cut_lineage(_memberships(vecs, centre, overlap))
    spans = members.where("rank = 0").groupBy("shard").agg(F.max("angle").alias("r"), F.count("*").alias("n")).toPandas()   # one row per centre
    tight = {int(s): float(r) for s, r in zip(spans["shard"], spans["r"]) if r <= 2 * math.acos(min(1.0, least))}
    adjacency = cut_lineage(_adjacency(members, degree))
    # audited are vectors that the centres weren't fitted on; where the fit had all of them, those
    other = vecs.where(hash_share("rep", AUDIT_MOST * audit_queries, n, after=sample_rows)).select("rep", "v").toArrow()
    drawn = other if other.num_rows >= max(audit_queries, 1) else picked
    want = _audited(vecs, drawn.column(0).to_numpy(), np.array(drawn.column(1).combine_chunks().flatten().to_numpy()).reshape(drawn.num_rows, -1),
                    least, audit_queries)
    while True:
        hits = cut_lineage(_hits(members, adjacency, _ask(members, centre, tight, probes, least), least, beam))
        hits = cut_lineage(_both_ends(members, hits, least))
        if beam is None:
            break
        found = hits.where("finds").where(F.col("rep").isin(list(want))).groupBy("rep").agg(F.sum("n").alias("n")).collect() if want else []
        if _recall(want, {r["rep"]: r["n"] for r in found}) >= aim:
            break
        probes, beam = (min(len(centre), probes * 2), beam * 2) if probes < len(centre) else (probes, None)
    return (hits.where("finds").groupBy("rep").agg(F.sum("copies").alias("others")),
            hits.where("finds is null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
