"""Mixing sources to target shares (problem 9) with the cube method.

The total is the largest one at which every source can give its share without being used more often than it may. A source then
has to be used m times on average: each of its documents floor(m) times, and once more with probability m - floor(m). The cube
method picks these extra uses: probabilities walk along directions that change neither the expected tokens nor the expected
number of documents until each is 0 or 1 or too few are left to move. Blocks of documents fly in parallel; what is left of a
block, at most two documents, flies again among the rest of all blocks, and so on; the last few of a source land on the side that
brings its tokens closest to the target. So that a long document left for the landing cannot spoil it, documents with more than 1/HEAD of a
source's tokens (fewer than HEAD for each source, whatever its size) fly and land first, longest sizes first, and the
probabilities of all shorter ones are shifted to make up for the difference.
"""

from __future__ import annotations

import itertools
import math
import random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.session import cut

BLOCK = 5_000
HEAD = 2_000
EPS = 1e-9


def flight(pi: list[float], tokens: list[float], rng: random.Random) -> list[float]:
    """Probabilities after the flight: all 0 or 1 but for at most two, with the sums of pi and of pi * tokens kept."""
    pi = list(pi)
    open_ones = [i for i, p in enumerate(pi) if EPS < p < 1 - EPS]
    queue = open_ones[::-1]
    hand: list[int] = []
    while True:
        while len(hand) < 3 and queue:
            hand.append(queue.pop())
        if len(hand) < 3:
            break
        a, b, c = hand
        # the direction orthogonal to (1, 1, 1) and to the tokens
        u = (tokens[c] - tokens[b], tokens[a] - tokens[c], tokens[b] - tokens[a])
        if max(map(abs, u)) < EPS:
            u = (1.0, -1.0, 0.0)
        up = min(((1 - pi[i]) / d if d > 0 else pi[i] / -d) for i, d in zip(hand, u) if abs(d) > EPS)
        down = min((pi[i] / d if d > 0 else (1 - pi[i]) / -d) for i, d in zip(hand, u) if abs(d) > EPS)
        step = up if rng.random() < down / (up + down) else -down
        for i, d in zip(hand, u):
            pi[i] += step * d
            if pi[i] < EPS:
                pi[i] = 0.0
            elif pi[i] > 1 - EPS:
                pi[i] = 1.0
        hand = [i for i in hand if 0.0 < pi[i] < 1.0]
    return pi


def land(pi: list[float], tokens: list[float], below: bool = False) -> list[float]:
    """All probabilities to 0 or 1, so that the tokens come closest to the expected ones; for a handful of documents.
    below: what is missing can still be made up for, what is too much can't, so the closest from below is taken."""
    want = sum(p * t for p, t in zip(pi, tokens))
    loose = [i for i, p in enumerate(pi) if 0.0 < p < 1.0]
    sure = sum(t for p, t in zip(pi, tokens) if p >= 1.0)
    best = min(itertools.product((0.0, 1.0), repeat=len(loose)), key=lambda c: ((gap := sure + sum(x * tokens[i] for x, i in zip(c, loose)) - want) > EPS and below, abs(gap), c))
    out = list(pi)
    for x, i in zip(best, loose):
        out[i] = x
    return out


def settle(tokens: list[float], f: float, rng: random.Random) -> tuple[list[float], float]:
    """(0 or 1 for each document, tokens picked beyond the expected ones) for the documents of the head, in classes of falling size."""
    order = sorted(range(len(tokens)), key=lambda i: (-tokens[i], i))
    out = [0.0] * len(tokens)
    beyond, at = 0.0, 0
    while at < len(order):
        end = at
        while end < len(order) and (end - at < 8 or tokens[order[end]] * 2 > tokens[order[at]]):
            end += 1
        group = order[at:end]
        tk = [tokens[i] for i in group]
        whole = sum(tk)
        want = f * whole - beyond
        p = min(1.0, max(0.0, want / whole))
        shuffled = list(range(len(group)))
        rng.shuffle(shuffled)
        smaller = sum(tokens[i] for i in order[end:])
        got = land(flight([p] * len(group), [tk[i] for i in shuffled], rng), [tk[i] for i in shuffled], below=(1 - f) * smaller > tk[0])
        picked = 0.0
        for i, x in zip(shuffled, got):
            out[group[i]] = x
            picked += x * tk[i]
        beyond += picked - f * whole
        at = end
    return out, beyond


def _settler(seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id").reset_index(drop=True)
        picks, _ = settle(pdf["n_tokens"].astype(float).tolist(), float(pdf["pi"].iat[0]), random.Random(f"{seed}|head|{pdf['source'].iat[0]}"))
        return pdf.assign(pi=picks)[["doc_id", "source", "n_tokens", "pi"]]

    return run


def _flier(seed: int, level: int, last: bool):
    """The flight of one block; the order of its documents and the way they go depend on the seed, the level and the block alone."""

    def fly(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id").reset_index(drop=True)
        order = list(range(len(pdf)))
        rng = random.Random(f"{seed}|{level}|{pdf['source'].iat[0]}|{pdf['b'].iat[0]}")
        rng.shuffle(order)
        pi, tk = pdf["pi"].tolist(), pdf["n_tokens"].astype(float).tolist()
        got = flight([pi[i] for i in order], [tk[i] for i in order], rng)
        if last:
            got = land(got, [tk[i] for i in order])
        for i, p in zip(order, got):
            pi[i] = p
        return pdf.assign(pi=pi)[["doc_id", "source", "n_tokens", "pi"]]

    return fly


def mix(sizes: DataFrame, targets: dict[str, tuple[float, int]], total: float | None = None, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """(doc_id, source, n_tokens, n_uses) for every row of sizes(doc_id, source, n_tokens).

    targets: source -> (share of the total tokens, greatest number of uses of a document). Shares are scaled to a sum of 1 over the sources that have
    documents; sources that are not wanted, null ones among them, get 0 uses. total: wanted tokens; more than the feasible total is reduced to it.
    doc_id must be unique. No documents give no rows.
    """
    have = {r["source"]: (r["n"], float(r["t"])) for r in sizes.where(F.col("source").isin(list(targets))).groupBy("source").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t")).collect()}  # one row a target
    wanted = {s: targets[s] for s in targets if s in have and have[s][1] > 0 and targets[s][0] > 0 and targets[s][1] > 0}
    if not wanted:
        return sizes.select("doc_id", "source", "n_tokens", F.lit(0).alias("n_uses"))
    whole = sum(v[0] for v in wanted.values())
    feasible = min(k * have[s][1] * whole / share for s, (share, k) in wanted.items())
    goal = feasible if total is None else min(total, feasible)
    mean = {s: min(float(k), share / whole * goal / have[s][1]) for s, (share, k) in wanted.items()}
    base = {s: min(math.floor(m + EPS), targets[s][1]) for s, m in mean.items()}
    extra = {s: max(0.0, mean[s] - base[s]) for s in mean}
    extra = {s: (0.0 if f < 1e-7 else f) for s, f in extra.items()}

    def by_source(values: dict, other):
        return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("source")), F.lit(other))

    rows = cut(sizes.select("doc_id", "source", "n_tokens").withColumn("base", by_source(base, 0)).withColumn("pi", by_source(extra, 0.0)))
    done = [rows.where("pi = 0").select("doc_id", F.lit(0.0).alias("pi"))]
    loose = rows.where("pi > 0").select("doc_id", "source", "n_tokens", "pi")
    schema = f"doc_id {sizes.schema['doc_id'].dataType.simpleString()}, source string, n_tokens bigint, pi double"
    long = F.col("n_tokens") > by_source({s: have[s][1] / HEAD for s in extra}, float("inf"))
    head = cut(loose.where(long).groupBy("source").applyInPandas(_settler(seed), schema))
    done.append(head.select("doc_id", "pi"))
    # what the head took beyond its due, and what is left to choose from: one row a target
    took = {r["source"]: (float(r["t"]), float(r["p"])) for r in head.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens") * F.col("pi")).alias("p")).collect()}
    shifted = {}
    for s, f in extra.items():
        t, p = took.get(s, (0.0, 0.0))
        rest = have[s][1] - t
        shifted[s] = min(1.0, max(0.0, (f * have[s][1] - p) / rest)) if rest > 0 else 0.0
    loose = loose.where(~long).withColumn("pi", by_source(shifted, 0.0))
    sure = cut(loose.where("pi = 0 or pi = 1"))
    done.append(sure.select("doc_id", "pi"))
    loose = loose.where("pi > 0 and pi < 1")
    counts = {r["source"]: r["count"] for r in loose.groupBy("source").count().collect()}  # one row a target
    level = 0
    while counts:
        blocks = {s: max(1, math.ceil(n / block)) for s, n in counts.items()}
        last = max(blocks.values()) == 1

        shard = F.pmod(F.xxhash64("doc_id", F.lit(level)), by_source(blocks, 1))
        flown = cut(loose.withColumn("b", shard).groupBy("source", "b").applyInPandas(_flier(seed, level, last), schema))
        done.append(flown.where("pi = 0 or pi = 1").select("doc_id", "pi"))
        if last:
            break
        loose = flown.where("pi > 0 and pi < 1")
        counts = {r["source"]: r["count"] for r in loose.groupBy("source").count().collect()}  # one row a target
        level += 1
    picked = done[0]
    for x in done[1:]:
        picked = picked.unionByName(x)
    return rows.join(picked.select("doc_id", F.col("pi").alias("one_more")), "doc_id").select("doc_id", "source", "n_tokens", (F.col("base") + F.col("one_more")).cast("int").alias("n_uses"))


def mix_report(uses: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, share, n_tokens, n_documents, most_uses) for each row of targets(source, target_share, max_repeats)."""
    by = uses.where("n_uses > 0").groupBy("source").agg(F.sum(F.col("n_uses") * F.col("n_tokens")).alias("n_tokens"), F.sum("n_uses").alias("n_documents"), F.max("n_uses").alias("most_uses"))
    total = by.agg(F.sum("n_tokens").alias("total"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return targets.join(by, "source", "left").crossJoin(F.broadcast(total)).select(
        "source", "target_share", (zero("n_tokens") / F.greatest(zero("total"), F.lit(1))).alias("share"), zero("n_tokens").alias("n_tokens"), zero("n_documents").alias("n_documents"), zero("most_uses").alias("most_uses"), "max_repeats"
    )
