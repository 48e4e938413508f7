"""Most similar vectors for every vector (problem 4): balanced posting lists.

Shape of the search
-------------------
1. Usable vectors are reduced to their direction in 16-bit steps; vectors with the same direction
   are one representative, so a group of copies of any size is one row from here on.
2. Centroids are fitted per profile, on the executors, on a bounded, documented sample (about
   ``fit_sample`` vectors of the profile, all where it has fewer, chosen by hash) and balanced: a
   centroid with too much of the sample is split, so lists hold about ``list_size``.
3. Centroids are the nodes of an in-memory neighbour graph, all of them doors into it, so each vector
   is compared with all centroids of its profile and joins the lists of its nearest centroids: the nearest one, and others as long as their distance
   is within ``ratio`` of the nearest (vectors near a boundary are so replicated, at most
   ``replicas`` times). A vector is member and query of the same lists.
4. Each list is searched exhaustively. A list that the sample says is too long is cut into blocks,
   and every pair of blocks is searched by its own task, so no list is ever one group.
5. The best of all lists are merged per representative and turned into ids; copies take the
   smallest ids of their own group first.

Every vector is indexed and every usable vector is a query. Centroids and graph links of all
profiles are one table. It is broadcast if it is smaller than ``broadcast_bytes``; beyond (very many
large profiles) vectors meet the centroids of their own profile by a cogroup on (profile, salt).

Defined results: unusable vectors (null, of another length than ``dimensions``, with null, NaN or
infinite numbers, or all zero) are neither queries nor answers; rows with a null id or profile are
ignored; a repeated row counts once; a profile with fewer than six items pairs each with all others;
ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mnemolake.functions.timestamps import once
from mnemolake.runtime import written

STEP = 32767.0
MEET = 300_000  # vectors of a profile that meet its centroids in one task, where these are not broadcast
CENTROID = "profile_key string, list int, c binary, links binary, door boolean, blocks int"
IN_LISTS = "profile_key string, list int, g bigint, q binary, mb int, qb int, role int"


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """(``profile_key``, ``id``, ``q``, ``g``): direction in 16-bit steps and its hash."""
    e = embeddings.select("profile_key", F.col("memory_item_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), "dimensions")
    ok = (
        F.col("profile_key").isNotNull() & F.col("id").isNotNull() & (F.size("v") == F.col("dimensions")) & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0.0)
    )
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    e = once(e.where(F.coalesce(ok, F.lit(False))).withColumn("norm", norm), "norm")  # else computed again for each number
    e = once(e.withColumn("q", F.transform("v", lambda x: F.round(x / F.col("norm") * STEP).cast("smallint"))).drop("v", "norm"), "q")
    return e.select("profile_key", "id", "q", F.xxhash64("profile_key", "q").alias("g"))


def _unit(q: np.ndarray) -> np.ndarray:
    x = q.astype(np.float32)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return x


def fit_centroids(x: np.ndarray, lists: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means on a sample, then overfull centroids are split until none holds twice its share."""
    rng = np.random.default_rng(seed)
    lists = max(1, min(lists, len(x)))
    c = x[rng.choice(len(x), lists, replace=False)].copy()
    for _ in range(rounds):
        own = _nearest(x, c)
        c = _means(x, own, len(c), c)
    share = len(x) / lists
    for _ in range(6):
        own = _nearest(x, c)
        sizes = np.bincount(own, minlength=len(c))
        over = np.flatnonzero(sizes > 2 * share + 8)
        if not len(over):
            break
        new = []
        for o in over:
            part = x[own == o]
            pair = part[rng.choice(len(part), 2, replace=False)]
            for _ in range(4):
                side = _nearest(part, pair)
                pair = _means(part, side, 2, pair)
            c[o] = pair[0]
            new.append(pair[1])
        c = np.vstack([c, np.array(new, np.float32)])
    return c.astype(np.float32)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    step = max(16, (1 << 24) // max(1, len(c)))  # 64 MB of similarities at a time
    return np.concatenate([np.argmax(x[i : i + step] @ c.T, axis=1) for i in range(0, len(x), step)])


def _means(x: np.ndarray, own: np.ndarray, k: int, before: np.ndarray) -> np.ndarray:
    order = np.argsort(own, kind="stable")
    at = np.searchsorted(own[order], np.arange(k))
    filled = np.bincount(own, minlength=k) > 0
    out = before.copy()
    out[filled] = np.add.reduceat(x[order], at[filled], axis=0)
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return np.where(norms > 1e-9, out / np.maximum(norms, 1e-9), before).astype(np.float32)


class CentroidGraph:
    """Neighbour graph over centroids with beam search for many queries at once."""

    def __init__(self, c: np.ndarray, links: np.ndarray, doors: np.ndarray, blocks: np.ndarray):
        self.c, self.links, self.doors, self.blocks = c, links, doors, blocks

    @staticmethod
    def linked(c: np.ndarray, degree: int = 24) -> np.ndarray:
        """The nearest ``degree`` centroids of each, itself among them."""
        k = len(c)
        degree = min(degree, k - 1) if k > 1 else 0
        step = max(16, (1 << 24) // k)
        links = [np.argpartition(-(c[i : i + step] @ c.T), degree, axis=1)[:, : degree + 1] for i in range(0, k, step)] if degree else []
        return np.vstack(links).astype(np.int32) if links else np.zeros((k, 1), np.int32)

    @classmethod
    def of(cls, rows: pd.DataFrame) -> CentroidGraph:
        """The graph of one profile from its rows of ``CENTROID``."""
        rows = rows.sort_values("list")
        c = np.frombuffer(b"".join(rows["c"]), np.float32).reshape(len(rows), -1)
        links = np.frombuffer(b"".join(rows["links"]), np.int32).reshape(len(rows), -1)
        return cls(c, links, np.flatnonzero(rows["door"].to_numpy()).astype(np.int32), rows["blocks"].to_numpy().astype(np.int32))

    def search(self, x: np.ndarray, beam: int, steps: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of the ``beam`` best centroids found for each row, best first."""
        beam = min(beam, len(self.c))
        doors, width = self.c[self.doors], min(beam, len(self.doors))
        part = max(16, (1 << 22) // len(doors))  # 16 MB of similarities at a time
        ids = np.vstack([self.doors[np.argpartition(-(x[i : i + part] @ doors.T), width - 1, axis=1)[:, :width]] for i in range(0, len(x), part)])
        steps = steps if len(doors) < len(self.c) else 1  # all centroids were compared: only put in order
        for step in range(steps):
            wide = np.concatenate([ids, self.links[ids[:, : max(2, beam // 2)]].reshape(len(x), -1)], axis=1)
            wide.sort(axis=1)
            sims = np.einsum("bd,bkd->bk", x, self.c[wide], optimize=True)
            sims[:, 1:][wide[:, 1:] == wide[:, :-1]] = -np.inf  # the same centroid again
            keep = min(beam, wide.shape[1])
            best = np.argpartition(-sims, keep - 1, axis=1)[:, :keep]
            found = np.take_along_axis(sims, best, 1)
            order = np.argsort(-found, axis=1)
            best, found = np.take_along_axis(best, order, 1), np.take_along_axis(found, order, 1)
            new = np.take_along_axis(wide, best, 1)
            if new.shape == ids.shape and np.array_equal(new, ids):
                break
            ids = new
        return ids, found


def _fitter(list_size: int, max_lists: int):
    """applyInPandas step: centroids, links and block counts of one profile from its sample."""

    def run(sample: pd.DataFrame) -> pd.DataFrame:
        n = int(sample["n"].iloc[0])
        x = _unit(np.stack(sample.sort_values("g")["q"].to_numpy()))
        c = fit_centroids(x, min(max_lists, int(np.ceil(n / list_size))))
        links, k = CentroidGraph.linked(c), len(c)
        door = np.ones(k, bool)  # links alone don't lead from one cluster to another: with few doors a third of the vectors miss their nearest of 30,000 lists
        share = np.bincount(_nearest(x, c), minlength=k) * (n / len(x))
        blocks = np.where(share > 16 * list_size, np.ceil(share / (16 * list_size)), 1).astype(np.int32)
        return pd.DataFrame({"profile_key": sample["profile_key"].iloc[0], "list": np.arange(k, dtype=np.int32), "c": [r.tobytes() for r in c], "links": [r.tobytes() for r in links], "door": door, "blocks": blocks})

    return run


def _in_lists(graph: CentroidGraph, vectors: pd.DataFrame, replicas: int, ratio: float) -> Iterator[pd.DataFrame]:
    """The rows of each vector of one profile in its lists."""
    for i in range(0, len(vectors), 512):
        chunk = vectors.iloc[i : i + 512]
        q = np.stack(chunk["q"].to_numpy()).astype(np.int16)
        ids, sims = graph.search(_unit(q), beam=max(8, 2 * replicas))
        ids, sims = ids[:, :replicas], sims[:, :replicas]
        far = np.sqrt(np.maximum(2 - 2 * sims, 0))
        near = far <= far[:, :1] * ratio + 1e-6
        near &= np.isfinite(sims)
        row, col = np.nonzero(near)
        rows = pd.DataFrame({
            "profile_key": chunk["profile_key"].iloc[0], "list": ids[row, col].astype(np.int32),
            "g": chunk["g"].to_numpy()[row], "q": [q[r].tobytes() for r in row],
        })
        yield _spread(rows, graph.blocks[rows["list"].to_numpy()])


def _assigned(reps: DataFrame, sizes: DataFrame, centroids: DataFrame, replicas: int, ratio: float, broadcast_bytes: int) -> DataFrame:
    spark = reps.sparkSession
    total = centroids.agg(F.sum(F.octet_length("c") + F.octet_length("links") + 64)).first()[0] or 0
    if total <= broadcast_bytes:
        graphs = {p: CentroidGraph.of(rows) for p, rows in centroids.toPandas().groupby("profile_key", sort=False)}
        sent = spark.sparkContext.broadcast(graphs)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = [rows for profile, part in batch.groupby("profile_key", sort=False) for rows in _in_lists(sent.value[profile], part, replicas, ratio)]
                if out:
                    yield pd.concat(out, ignore_index=True)

        return reps.mapInPandas(run, IN_LISTS)

    def meet(vectors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        parts = list(_in_lists(CentroidGraph.of(rows), vectors, replicas, ratio)) if len(vectors) else []
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"profile_key": [], "list": [], "g": [], "q": [], "mb": [], "qb": [], "role": []})

    salts = sizes.select("profile_key", F.ceil(F.col("n") / MEET).cast("int").alias("salts"))
    salted = reps.join(salts, "profile_key").withColumn("salt", F.pmod("g", F.col("salts")).cast("int")).drop("salts")
    everywhere = centroids.join(salts, "profile_key").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return salted.groupBy("profile_key", "salt").cogroup(everywhere.groupBy("profile_key", "salt")).applyInPandas(meet, IN_LISTS)


def _spread(rows: pd.DataFrame, n: np.ndarray) -> pd.DataFrame:
    """A list of ``n`` blocks has n*n cells (block of members, block of queries); role 3 is both."""
    own = (rows["g"].to_numpy() % np.maximum(n, 1)).astype(np.int32)
    plain = rows[n == 1].assign(mb=np.int32(0), qb=np.int32(0), role=np.int32(3))
    parts = [plain]
    for blocks in np.unique(n[n > 1]):
        hot, mine = rows[n == blocks], own[n == blocks]
        for b in range(int(blocks)):
            both = mine == b
            parts.append(hot.assign(mb=mine, qb=np.int32(b), role=np.where(both, 3, 1).astype(np.int32)))
            parts.append(hot[~both].assign(mb=np.int32(b), qb=mine[~both], role=np.int32(2)))
    return pd.concat(parts, ignore_index=True)


def _search_cell(k: int):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        q = np.frombuffer(b"".join(cell["q"]), dtype=np.int16).reshape(len(cell), -1)
        x, g, role = _unit(q), cell["g"].to_numpy(), cell["role"].to_numpy()
        members, asking = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
        best_ids, best = [], []
        for i in range(0, len(asking), 1024):
            rows = asking[i : i + 1024]
            sims = x[rows] @ x[members].T
            sims[g[rows][:, None] == g[members][None, :]] = -np.inf
            width = min(k, sims.shape[1])
            top = np.argpartition(-sims, width - 1, axis=1)[:, :width]
            best.append(np.take_along_axis(sims, top, 1))
            best_ids.append(g[members][top])
        if not len(asking) or not len(members):
            return pd.DataFrame({"g": pd.Series(dtype="int64"), "s": [], "o": []})
        s, o = np.vstack(best), np.vstack(best_ids)
        s = -np.round(s.astype(np.float32), 6)
        others = np.isfinite(s)  # a short list gives back the vector itself
        return pd.DataFrame({"g": g[asking], "s": [a[m] for a, m in zip(s, others)], "o": [a[m] for a, m in zip(o, others)]})

    return run


def neighbour_pairs(
    embeddings: DataFrame, k: int = 5, list_size: int = 256, replicas: int = 3, ratio: float = 1.15, fit_sample: int = 60_000, max_lists: int = 65_536, broadcast_bytes: int = 128 << 20
) -> DataFrame:
    """(``profile_key``, ``left_id``, ``right_id``): pairs where one is among the other's ``k`` most similar."""
    v = usable_vectors(embeddings)
    members = written(v.groupBy("profile_key", "g", "id").agg(F.lit(1).alias("one")).drop("one"), "vector-members")
    reps = written(v.groupBy("profile_key", "g").agg(F.first("q").alias("q")), "vector-representatives")

    sizes = written(reps.groupBy("profile_key").agg(F.count("*").alias("n")), "vector-profiles")  # one row per profile
    chosen = F.pmod(F.xxhash64("g", F.lit(17)), F.ceil(F.col("n") / fit_sample)) == 0
    fitted = reps.join(sizes, "profile_key").where(chosen).groupBy("profile_key").applyInPandas(_fitter(list_size, max_lists), CENTROID)
    in_lists = _assigned(reps, sizes, written(fitted, "vector-centroids"), replicas, ratio, broadcast_bytes)
    found = in_lists.groupBy("profile_key", "list", "mb", "qb").applyInPandas(_search_cell(k), "g bigint, s array<float>, o array<bigint>")
    best = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("s", "o"))))), 1, k + 1)
    near = found.groupBy("g").agg(best.alias("b")).select("g", F.inline("b"))

    first = members.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("id"))).where(F.col("r") <= k + 1)
    firsts = written(first.groupBy("g").agg(F.array_sort(F.collect_list("id")).alias("ids")), "vector-first-ids")
    others = near.join(firsts.select(F.col("g").alias("o"), "ids"), "o").select("g", "s", F.explode(F.slice("ids", 1, k)).alias("id"))
    outside = others.groupBy("g").agg(F.slice(F.array_sort(F.collect_list(F.struct("s", "id"))), 1, k).alias("near"))

    mine = members.join(firsts, "g").join(outside, "g", "left")
    inside = F.slice(F.array_except("ids", F.array("id")), 1, k)
    answers = F.slice(F.concat(inside, F.coalesce(F.transform("near", lambda x: x["id"]), F.array().cast("array<string>"))), 1, k)
    pairs = mine.select("profile_key", "id", F.explode(answers).alias("other"))
    return pairs.select("profile_key", F.least("id", "other").alias("left_id"), F.greatest("id", "other").alias("right_id")).distinct()
