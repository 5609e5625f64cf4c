"""Problem 8: items of varying length into containers of fixed capacity.

Hierarchical residual packing: groups of items are packed best-fit decreasing
where they lie; bins that are nearly full, or that nothing left could join, are
final; the underfull ones go up a tree as items of their own and are packed
again. Only sizes travel, never texts.
"""

from __future__ import annotations

import base64
import math
import os

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import arrow_flat_map, checkpoint

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The split pattern that goes with the byte-level vocabulary (public, of the GPT-2 tokenizer).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_CAPACITIES = 1000
ITEMS_PER_GROUP, FAN_IN, NEARLY_FULL = 40_000, 8, 0.995
#: Levels in a row that may join no two bins before the tree ends.
IDLE_LEVELS = 2


def token_sizes(df: DataFrame, key: str, text: str, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``key, n_tokens`` by a public byte-level tokenizer; null and empty texts have zero tokens."""
    path = os.path.join(tokenizers, vocabulary)

    def make():
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

        def row(k, t):
            yield k, len(encoding.encode_ordinary(t)) if t else 0

        return row

    kind = df.schema[key].dataType.simpleString()
    return arrow_flat_map(df.select(key, text), make, f"`{key}` {kind}, n_tokens int")


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin of each size, and the fill of each bin: largest first, each into the fullest bin that takes it.

    Bins wait by their free space; a bit for each free space that occurs finds
    the least sufficient one without a search.
    """
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    occurs, bins, fill = 0, [0] * len(sizes), []
    for i in order:
        size = sizes[i]
        enough = occurs >> size
        if enough:
            free = size + (enough & -enough).bit_length() - 1
            b = waiting[free].pop()
            if not waiting[free]:
                occurs &= ~(1 << free)
        else:
            b, free = len(fill), capacity
            fill.append(0)
        bins[i] = b
        fill[b] += size
        waiting[free - size].append(b)
        occurs |= 1 << (free - size)
    return bins, fill


def _pack(level: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        capacity = int(pdf["max_tokens"].iloc[0])
        # the same rows in any order give the same bins
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True], kind="stable")
        bins, fill = best_fit(pdf["size"].tolist(), capacity)
        head = f"{level}.{int(pdf['grp'].iloc[0])}."
        return pd.DataFrame({"capacity_id": pdf["capacity_id"], "max_tokens": pdf["max_tokens"], "item": pdf["item"], "size": pdf["size"], "bin": [head + str(b) for b in bins], "fill": [fill[b] for b in bins]})

    return pack


_PACKED = "capacity_id int, max_tokens int, item string, size int, bin string, fill int"


def _packed(items: DataFrame, groups: Column, level: int) -> DataFrame:
    ship(items.sparkSession)
    return items.withColumn("grp", groups).groupBy("capacity_id", "grp").applyInPandas(_pack(level), _PACKED)


def pack(sizes: DataFrame, key: str, size: str, capacities: DataFrame, capacity_id: str = "capacity_id", capacity: str = "max_tokens", items_per_group: int = ITEMS_PER_GROUP, fan_in: int = FAN_IN, nearly_full: float = NEARLY_FULL) -> DataFrame:
    """``capacity_id, key, piece, piece_tokens, container``: the container of every piece of every item.

    An item within the capacity is one piece and is never split; a larger one
    is cut into full pieces and a rest. Full pieces are containers of their
    own. Sizes of zero or null count as zero and share any container. Rows with
    a null key are packed like others. Capacities must be positive; they are a
    short list (its number is checked).
    """
    few = capacities.select(F.col(capacity_id).cast("int"), F.col(capacity).cast("int")).where(F.col(capacity).cast("int") > 0).limit(MAX_CAPACITIES + 1).collect()
    if len(few) > MAX_CAPACITIES:
        raise ValueError(f"more than {MAX_CAPACITIES} capacities")
    each = F.array(*[F.struct(F.lit(c[0]).cast("int").alias("capacity_id"), F.lit(c[1]).cast("int").alias("max_tokens")) for c in few]) if few else F.array().cast("array<struct<capacity_id:int,max_tokens:int>>")
    rows = checkpoint(sizes.select(F.col(key).alias("_k"), F.coalesce(F.col(size), F.lit(0)).cast("int").alias("_n"), F.monotonically_increasing_id().alias("_row")))
    pieces = (
        rows.select("*", F.inline(each))
        .withColumn("_pieces", F.greatest(F.lit(1), F.ceil(F.col("_n") / F.col("max_tokens")).cast("int")))
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        .withColumn("size", F.least(F.col("max_tokens"), F.col("_n") - F.col("piece") * F.col("max_tokens")).cast("int"))
        .withColumn("item", F.concat_ws(":", "_row", "piece"))
    )
    full = pieces.where("size = max_tokens")
    open_ = pieces.where("size < max_tokens")
    n = rows.count()
    groups = max(1, math.ceil(n / items_per_group))
    # the row number sets the group: items of all sizes spread evenly, whatever their keys
    packed = checkpoint(_packed(open_.select("capacity_id", "max_tokens", "item", "size"), F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int"), 0))
    moved = None
    level, current, idle = 0, packed, 0
    while groups > 1 and idle < IDLE_LEVELS:
        level += 1
        bins = current.groupBy("capacity_id", "max_tokens", "bin").agg(F.first("fill").alias("size"))
        residual = bins.where(F.col("size") < F.lit(nearly_full) * F.col("max_tokens"))
        least = residual.groupBy("capacity_id").agg(F.min("size").alias("_least"))
        residual = residual.join(F.broadcast(least), "capacity_id").where(F.col("size") + F.col("_least") <= F.col("max_tokens")).drop("_least")  # one row for each capacity
        left = residual.select("capacity_id", "max_tokens", F.col("bin").alias("item"), F.col("size").cast("int").alias("size"))
        # a group never takes more than its share of the residual bins
        count, total = left.groupBy("capacity_id").count().agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
        spread = max(math.ceil(groups / fan_in), math.ceil(count / items_per_group))
        current = checkpoint(_packed(left, F.pmod(F.xxhash64("item"), F.lit(spread)).cast("int"), level))
        # bins have new names at each level, so that other ones meet even in as many groups
        idle = idle + 1 if spread == groups and current.select("capacity_id", "bin").distinct().count() == total else 0
        groups = spread
        step = current.select("capacity_id", F.col("item").alias("bin"), F.col("bin").alias("to"))
        if moved is None:
            moved = step
        else:
            onward = step.select("capacity_id", F.col("bin").alias("to"), F.col("to").alias("next"))
            moved = moved.join(onward, ["capacity_id", "to"], "left").select("capacity_id", "bin", F.coalesce("next", "to").alias("to")).unionByName(step)
    final = packed.select("capacity_id", "item", "bin")
    if moved is not None:
        final = final.join(moved, ["capacity_id", "bin"], "left").select("capacity_id", "item", F.coalesce("to", "bin").alias("bin"))
    mine = open_.select("capacity_id", "item", "_k", "piece", "size").join(final, ["capacity_id", "item"])
    whole = full.select("capacity_id", "item", "_k", "piece", "size", F.concat(F.lit("full."), "item").alias("bin"))
    return mine.unionByName(whole).select("capacity_id", F.col("_k").alias(key), "piece", F.col("size").alias("piece_tokens"), F.col("bin").alias("container"))


def fill_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """``capacity_id, containers, pieces, tokens, fill_share``: how well each capacity is used."""
    per = packed.groupBy("capacity_id").agg(F.count_distinct("container").alias("containers"), F.count(F.lit(1)).alias("pieces"), F.sum("piece_tokens").alias("tokens"))
    return per.join(capacities.select("capacity_id", "max_tokens"), "capacity_id").select("capacity_id", "containers", "pieces", "tokens", (F.col("tokens") / (F.col("containers") * F.col("max_tokens"))).alias("fill_share"))
