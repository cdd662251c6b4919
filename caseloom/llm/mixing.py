"""Problem 8: mixing sources to target weights.

Tokens are dealt out in equal blocks. The largest total is taken for which no source with a block of
texts runs out within its repeats; its blocks go to the sources by Sainte-Lague's highest quotients, and each
source's blocks to its shards likewise, which makes whole-number quotas before anything is selected.
A shard's texts, in an order drawn from the seed, are cut into blocks of as many tokens; all blocks are used as
often as the quota holds the shard, and the first of them once more.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseloom.llm.content import plain_source
from caseloom.llm.tokens import TOKENIZER, with_tokens
from caseloom.session import stored

#: Tokens of a block; shards hold about so many tokens; shards are apportioned in so many groups a source on the driver,
#: within a group (of any number of shards) by a task.
BLOCK, SHARD_TOKENS, SHARD_GROUPS = 64, 2_000_000, 1_024


def sainte_lague(weights: dict, seats: int, caps: dict | None = None) -> dict:
    """Seats by the highest quotients weight / (2 seats + 1); ties to the smaller key; none above its cap.

    Starts from whole shares rounded down, which the highest quotients always reach, and deals out the rest.
    """
    caps = caps or {}
    live = {k: w for k, w in weights.items() if w > 0}
    got = dict.fromkeys(weights, 0)
    total = sum(live.values())
    if not live or seats <= 0:
        return got
    for k, w in live.items():
        got[k] = min(caps.get(k, seats), max(0, int(seats * w / total) - 1))
    left = seats - sum(got.values())
    heap = [(-w / (2 * got[k] + 1), k) for k, w in live.items() if got[k] < caps.get(k, seats)]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, k = heapq.heappop(heap)
        got[k] += 1
        left -= 1
        if got[k] < caps.get(k, seats):
            heapq.heappush(heap, (-live[k] / (2 * got[k] + 1), k))
    return got


def quotas(targets: dict[str, tuple[float, int]], held: dict[tuple[str, int], int], block: int = BLOCK, total_tokens: int | None = None) -> dict[tuple[str, int], int]:
    """Tokens wanted of each (source, shard). ``targets``: share and repeats; ``held``: tokens there."""
    shards: dict[str, dict[int, int]] = {}
    for (s, i), n in held.items():
        shards.setdefault(s, {})[i] = n
    shares = {s: w for s, (w, repeats) in targets.items() if w > 0 and repeats > 0 and sum(shards.get(s, {}).values()) > 0}
    if not shares:
        return {}
    room = {s: {i: n * targets[s][1] // block for i, n in shards[s].items()} for s in shares}
    cap = {s: sum(room[s].values()) for s in shares}
    # A source without one whole block does not bound the total: its texts are used as often as they may be, and it falls short.
    small = {s: shares.pop(s) for s, c in cap.items() if c == 0}
    if not shares:
        return quotas(targets, held, 1, total_tokens) if block > 1 else {}
    whole = sum(shares.values())
    most = min(cap[s] * whole / w for s, w in shares.items())
    blocks = int(most if total_tokens is None else min(most, total_tokens // block))
    few = {(s, i): min(n * targets[s][1], int(w * blocks * block / whole)) for s, w in small.items() for i, n in shards[s].items()}
    if total_tokens is not None:
        blocks = min(blocks, max(0, total_tokens - sum(few.values())) // block)
    out = {k: n for k, n in few.items() if n > 0}
    for s, n in sainte_lague(shares, blocks, cap).items():
        for i, q in sainte_lague(shards[s], n, room[s]).items():
            out[(s, i)] = q * block
    return out


def _targets(targets: DataFrame) -> dict[str, tuple[float, int]]:
    """source -> share, repeats. Rows of one source add up their shares; the fewest repeats hold."""
    named = targets.select(plain_source(F.col("source")).alias("source"), "target_share", "max_repeats").where("source is not null")
    rows = named.groupBy("source").agg(F.sum(F.greatest("target_share", F.lit(0.0))).alias("share"), F.min(F.coalesce(F.greatest("max_repeats", F.lit(0)), F.lit(0))).alias("repeats")).collect()
    return {r.source: (r.share or 0.0, r.repeats) for r in rows}


def shard_quotas(held: DataFrame, groups: DataFrame, repeats: dict[str, int], block: int) -> DataFrame:
    """source, shard, held, quota: each group's quota apportioned to its shards. held: source, group, shard, held; groups: source, group, quota."""

    def split(g: pd.DataFrame) -> pd.DataFrame:
        most, quota = repeats[g["source"].iloc[0]], int(g["quota"].iloc[0])
        each = dict(zip(g["shard"].tolist(), g["held"].tolist()))
        # A quota that is no whole number of blocks is that of a source below one block: its only shard's.
        unit = block if quota % block == 0 and sum(n * most // block for n in each.values()) * block >= quota else 1
        got = sainte_lague(each, quota // unit, {i: n * most // unit for i, n in each.items()})
        return g.assign(quota=[got[i] * unit for i in g["shard"].tolist()])[["source", "shard", "held", "quota"]]

    joined = held.join(groups, ["source", "group"])
    return joined.groupBy("source", "group").applyInPandas(split, "source string, shard bigint, held bigint, quota bigint")


def mix_documents(
    documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, seed: int = 7, block: int = BLOCK, total_tokens: int | None = None,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """doc_id, source, tokens, repeats: the texts used and how often.

    Defined results: sources count under one spelling, those without target or name are not used; a
    text that occurs several times is used as its smallest doc_id, so that copies cannot pass the
    cap; NULL, blank and empty texts are not used; a target source without texts gets nothing and the
    others keep their proportions; ties are broken by the seeded hash and doc_id; empty tables give no rows.
    """
    spark = documents.sparkSession
    wanted = _targets(targets)
    # As many rows as the targets name, which the driver holds.
    sources = F.broadcast(spark.createDataFrame([(s,) for s in sorted(wanted)], "source string"))
    full = F.col("text").isNotNull() & ~F.col("text").rlike(r"\A\s*\z")
    named = documents.where(full).select("doc_id", plain_source(F.col("source")).alias("source"), "text").join(sources, "source", "left_semi")
    counted = stored(with_tokens(named.withColumn("hash", F.sha2("text", 256)), ["doc_id", "source", "hash"], tokenizer=tokenizer), "token-counts")
    first = counted.groupBy("hash").agg(F.min(F.struct("doc_id", "source", "tokens")).alias("f")).select("f.*", F.xxhash64("hash", F.lit(seed)).alias("order"))
    texts = stored(first.where("tokens > 0"), "distinct-texts")
    # One row a source: how many shards it is dealt out over.
    shards = texts.groupBy("source").agg(F.greatest(F.lit(1), F.ceil(F.sum("tokens") / shard_tokens)).alias("shards"))
    dealt = texts.join(F.broadcast(shards), "source").withColumn("shard", F.pmod(F.xxhash64("order"), F.col("shards"))).drop("shards")
    held = stored(
        dealt.groupBy("source", "shard").agg(F.sum("tokens").alias("held")).withColumn("group", F.pmod("shard", F.lit(SHARD_GROUPS))), "shards"
    )
    by_group = {(r.source, r.group): r.held for r in held.groupBy("source", "group").agg(F.sum("held").alias("held")).collect()}  # SHARD_GROUPS a source
    plan = [(s, g, q) for (s, g), q in quotas(wanted, by_group, block, total_tokens).items()]
    quota = shard_quotas(held, spark.createDataFrame(plan, "source string, group bigint, quota bigint"), {s: r for s, (_, r) in wanted.items()}, block)
    before = F.sum("tokens").over(Window.partitionBy("source", "shard").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens")
    # A text is of the block its middle lies in; the blocks of the rest of the quota are used once more.
    middle = F.col("_before") + F.col("tokens") / 2
    once_more = F.when(F.floor(middle / block) < F.col("rest") / block, 1).otherwise(0)
    return (
        dealt.withColumn("_before", before)
        .join(quota.withColumn("rest", F.col("quota") % F.col("held")), ["source", "shard"])
        .select("doc_id", "source", "tokens", (F.floor(F.col("quota") / F.col("held")) + once_more).cast("int").alias("repeats"))
        .where("repeats > 0")
    )


def share_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: target and reached share, tokens and texts used, and the most often a text is used."""
    used = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("texts"), F.max("repeats").alias("most_repeats"))
    wanted = (
        targets.select(plain_source(F.col("source")).alias("source"), "target_share", "max_repeats")
        .groupBy("source")
        .agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    )
    whole = used.agg(F.sum("tokens").alias("all_tokens"))  # one row
    return (
        wanted.join(used, "source", "left")
        .join(F.broadcast(whole), F.lit(True), "left")
        .select(
            "source", "target_share", "max_repeats",
            F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
            F.coalesce(F.try_divide(F.coalesce("tokens", F.lit(0)), "all_tokens"), F.lit(0.0)).alias("reached_share"),
        )
    )
