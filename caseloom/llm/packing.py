"""Problem 7: filling fixed-capacity containers with items.

Texts (in tokens) above the capacity are cut: their whole containers are full and need no packing, only the
rests do. Those are spread over partitions of bounded size and each partition is packed with best-fit
decreasing. Partitions meet in groups, wider ones in each round. Lower bounds from dual feasible functions
certify a group whose number of containers cannot be beaten; it is left as it is. In a group with a gap the
partitions hand over the texts of their containers with room left, and best-fit decreasing runs again on them; the
old containers are kept unless the new ones are fewer, so no round makes anything worse.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.tokens import TOKENIZER, with_tokens
from caseloom.session import stored

#: Texts of a partition on average; what one task holds.
PER_PARTITION = 20_000

#: Capacities that one expression holds; more are taken in several.
CAPACITIES_AT_ONCE = 500


def lower_bound(sizes: dict[int, int], capacity: int, steps: int = 20) -> int:
    """Containers that ``sizes`` (size -> how many, none above the capacity) need at least.

    The most of: total volume; the u(k) functions; and the functions that round sizes above
    capacity - t up to 1 and those below t down to 0. All in whole numbers.
    """
    if not sizes:
        return 0
    s = np.array(sorted(sizes), dtype=np.int64)
    n = np.array([sizes[x] for x in s.tolist()], dtype=np.int64)
    if s[-1] > capacity:
        raise ValueError("a size is above the capacity")
    best = -(-int((s * n).sum()) // capacity)
    for k in range(1, steps + 1):
        scaled = (k + 1) * s
        value = np.where(scaled % capacity == 0, s * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((value * n).sum()) // (k * capacity)))
    order = s[(s * 2 <= capacity) & (s > 0)]
    if len(order):
        above, volume = np.concatenate([np.cumsum(n[::-1])[::-1], [0]]), np.concatenate([[0], np.cumsum(s * n)])
        first = np.searchsorted(s, order, side="left")
        last = np.searchsorted(s, capacity - order, side="right")
        value = above[last] * capacity + volume[last] - volume[first]
        best = max(best, int((-(-value // capacity)).max()))
    return max(best, 1)


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The container of each size: largest first, each into the fullest container with room for it.

    Open containers are kept by the room left, and the rooms in use as bits of one number, so that
    the tightest room is found without a search over containers.
    """
    place = [0] * len(sizes)
    by_room: dict[int, list[int]] = {}
    rooms = 0
    opened = 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fitting = rooms >> sizes[i]
        if fitting:
            room = sizes[i] + (fitting & -fitting).bit_length() - 1
            stack = by_room[room]
            box = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            room, box, opened = capacity, opened, opened + 1
        left = room - sizes[i]
        place[i] = box
        by_room.setdefault(left, []).append(box)
        rooms |= 1 << left
    return place


_SCHEMA = "capacity_id int, capacity int, home bigint, shard bigint, box bigint, doc_id string, piece_no int, tokens bigint, boxes bigint, bound bigint, room bigint"


def _pack(g: pd.DataFrame) -> pd.DataFrame:
    """Packs a partition; where its rows already have containers, keeps them unless the new are fewer."""
    g = g.sort_values(["tokens", "doc_id", "piece_no"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    capacity = int(g["capacity"].iloc[0])
    sizes = g["tokens"].tolist()
    bound = lower_bound(Counter(sizes), capacity)
    place = None
    if (g["box"] >= 0).all():
        old = pd.factorize(g["old_shard"].astype(str) + "/" + g["box"].astype(str))[0].tolist()
        if len(set(old)) > bound:
            place = best_fit_decreasing(sizes, capacity)
        if place is None or len(set(old)) <= len(set(place)):
            place = old
    else:
        place = best_fit_decreasing(sizes, capacity)
    g["box"] = place
    g["boxes"] = len(set(place))
    g["bound"] = bound
    g["room"] = capacity - g.groupby("box")["tokens"].transform("sum")
    return g[[c.split()[0] for c in _SCHEMA.split(", ")]]


def pieces(sized: DataFrame, capacities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(full, rests): capacity_id, capacity, doc_id, place, piece_no, tokens of the whole containers of texts above the
    capacity, and of what is left of each text (all of it, where it fits)."""
    caps = [(r.capacity_id, r.capacity_tokens) for r in capacities.where("capacity_tokens > 0").select("capacity_id", "capacity_tokens").distinct().orderBy("capacity_id").collect()]
    groups = [caps[k : k + CAPACITIES_AT_ONCE] for k in range(0, len(caps), CAPACITIES_AT_ONCE)] or [[]]
    kind = "array<struct<capacity_id:int,capacity:int>>"
    array = lambda g: F.array(*[F.struct(F.lit(i).cast("int").alias("capacity_id"), F.lit(c).cast("int").alias("capacity")) for i, c in g]).cast(kind)
    # As text, a NULL among the ids does not make numbers of floating point of the others in pandas.
    each = reduce(DataFrame.unionByName, [sized.select(F.col("doc_id").cast("string").alias("doc_id"), "tokens", "place", F.inline(array(g))) for g in groups])
    whole = F.floor(F.col("tokens") / F.col("capacity")).cast("int")
    columns = ["capacity_id", "capacity", "doc_id", "place", "piece_no"]
    full = each.where(F.col("tokens") >= F.col("capacity")).select(*columns[:4], F.explode(F.sequence(F.lit(1), whole)).alias("piece_no"), F.col("capacity").cast("bigint").alias("tokens"))
    rest = (F.col("tokens") - whole * F.col("capacity")).cast("bigint")
    rests = each.withColumns({"piece_no": whole + 1, "rest": rest}).where((F.col("rest") > 0) | (F.col("tokens") == 0)).select(*columns, F.col("rest").alias("tokens"))
    return full, rests


def uncertified(packed: DataFrame) -> DataFrame:
    """capacity_id, group, gap: the groups of partitions with more containers than the lower bound of all their items."""
    histogram = packed.groupBy("capacity_id", "group", "capacity", "tokens").count()  # no more rows a group than the capacity has sizes

    def bound(g: pd.DataFrame) -> pd.DataFrame:
        sizes = dict(zip(g["tokens"].tolist(), g["count"].tolist()))
        first = g.iloc[0]
        return pd.DataFrame({"capacity_id": [first["capacity_id"]], "group": [first["group"]], "bound": [lower_bound(sizes, int(first["capacity"]))]})

    bounds = histogram.groupBy("capacity_id", "group").applyInPandas(bound, "capacity_id int, group bigint, bound bigint")
    boxes = packed.groupBy("capacity_id", "group", "shard", "box").agg(F.lit(1).alias("one")).groupBy("capacity_id", "group").agg(F.count("*").alias("boxes"))
    return stored(boxes.join(bounds, ["capacity_id", "group"]).where("boxes > bound").select("capacity_id", "group", (F.col("boxes") - F.col("bound")).alias("gap")), "gaps")


def pack_documents(
    documents: DataFrame, capacities: DataFrame, tokenizer: str = TOKENIZER, per_partition: int = PER_PARTITION, rounds: int = 3, merge: int = 8
) -> DataFrame:
    """capacity_id, container_id, doc_id, piece_no, start_token, tokens, and the container's ``room`` left.

    Defined results: every document is in a container of every capacity; NULL and empty texts take 0
    tokens; only a text above the capacity is cut; copies and repeated rows are items of their own;
    ties in size go by doc_id; an empty table gives no rows.
    """
    counted = stored(with_tokens(documents, ["doc_id"], tokenizer=tokenizer), "token-counts")
    shards = max(1, -(-counted.count() // per_partition))
    full, rests = pieces(counted.withColumn("place", F.monotonically_increasing_id()), capacities)
    # A text has one rest at most, so a partition has as many items as texts. Dealt out by id and place in the
    # stored table, so that repeated ids do not meet in one partition.
    home = F.pmod(F.xxhash64("doc_id", "place"), F.lit(shards))
    items = rests.withColumns({"home": home, "shard": home, "old_shard": F.lit(-1).cast("bigint"), "box": F.lit(-1).cast("bigint")})
    packed = stored(items.groupBy("capacity_id", "shard").applyInPandas(_pack, _SCHEMA), "packed-0")
    for n in range(1, rounds + 1):
        if merge ** (n - 1) >= shards:  # all partitions have met
            break
        group = F.floor(F.col("home") / F.lit(merge**n))
        gaps = uncertified(packed.withColumn("group", group))
        if gaps.isEmpty():
            continue  # wider groups may have one
        # Later rounds join more partitions and take only emptier containers.
        with_gap = packed.withColumn("group", group).join(F.broadcast(gaps), ["capacity_id", "group"], "left")  # one row a group
        open_boxes = F.col("gap").isNotNull() & (F.col("room") * F.lit(max(1, 64 // 4 ** (n - 1))) > F.col("capacity"))
        again = (
            with_gap.where(open_boxes)
            .withColumns({"old_shard": F.col("shard"), "shard": F.col("group") + F.lit(n * shards)})
            .groupBy("capacity_id", "shard")
            .applyInPandas(_pack, _SCHEMA)
        )
        packed = stored(with_gap.where(~open_boxes).select(*packed.columns).unionByName(again), f"packed-{n}")
    cut = full.select(
        "capacity_id", "capacity", F.concat_ws("/", "capacity_id", F.lit("full"), "place", "piece_no").alias("container_id"), "doc_id", "piece_no", "tokens", F.lit(0).cast("bigint").alias("room")
    )
    filled = packed.select("capacity_id", "capacity", F.concat_ws("/", "capacity_id", "shard", "box").alias("container_id"), "doc_id", "piece_no", "tokens", "room")
    return filled.unionByName(cut).select(
        "capacity_id",
        "container_id",
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "piece_no",
        ((F.col("piece_no") - 1) * F.col("capacity")).cast("bigint").alias("start_token"),
        "tokens",
        "room",
    )


def fill_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """Per capacity: containers used, the certified lower bound over all texts, tokens, and the share of room filled."""
    caps = capacities.select("capacity_id", F.col("capacity_tokens").alias("capacity")).distinct()
    histogram = packed.groupBy("capacity_id", "tokens").count()  # no more rows than the capacity has sizes

    def bound(g: pd.DataFrame) -> pd.DataFrame:
        sizes = dict(zip(g["tokens"].tolist(), g["count"].tolist()))
        return pd.DataFrame({"capacity_id": [g["capacity_id"].iloc[0]], "lower_bound": [lower_bound(sizes, int(g["capacity"].iloc[0]))]})

    bounds = histogram.join(caps, "capacity_id").groupBy("capacity_id").applyInPandas(bound, "capacity_id int, lower_bound bigint")
    boxes = packed.groupBy("capacity_id", "container_id").agg(F.sum("tokens").alias("tokens"))
    used = boxes.groupBy("capacity_id").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest"))
    return (
        used.join(bounds, "capacity_id")
        .join(caps, "capacity_id")
        .select("capacity_id", "capacity", "containers", "lower_bound", "tokens", "fullest", (F.col("tokens") / (F.col("containers") * F.col("capacity"))).alias("filled"))
    )
