"""Sharding by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import token_hash

#: A prime; at 64 shards each has 100 slots or more, so equal shards differ by one per cent.
SLOTS = 6421
#: The table is a literal of the plan, so its size is fixed: at most this many slots.
MAX_SLOTS = 1 << 20


def _number(*parts: object) -> int:
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_slots(turns: Mapping[str, int], slots: int = SLOTS, seed: object = "slots") -> list[str]:
    """Owner of each slot.

    Every shard visits the slots in an order of its own, ``offset + k * skip`` modulo the
    prime. Shards go round by name; at its turn a shard claims its next free slots, as many
    as its number in ``turns``. Adding or losing a shard moves few other slots.
    """
    if not is_prime(slots) or slots > MAX_SLOTS:
        raise ValueError(f"slots: a prime of at most {MAX_SLOTS}")
    if not turns or min(turns.values()) < 1 or len(turns) > slots:
        raise ValueError("turns: one shard or more, none without turns, no more than slots")
    owner: list[str | None] = [None] * slots
    orders = {s: [_number(seed, "offset", s) % slots, _number(seed, "skip", s) % (slots - 1) + 1 if slots > 2 else 1]
              for s in sorted(turns)}
    free = slots
    while free:
        for shard, order in orders.items():
            for _ in range(min(turns[shard], free)):
                while owner[order[0]] is not None:
                    order[0] = (order[0] + order[1]) % slots
                owner[order[0]] = shard
                free -= 1
    return owner


def slot_table(spark: SparkSession, owner: list[str]) -> DataFrame:
    """``slot, shard`` from the filled table, split from one literal."""
    if any("," in s for s in owner):
        raise ValueError("shard names hold no comma")
    names = F.split(F.lit(",".join(owner)), ",")
    return spark.range(len(owner)).select(F.col("id").alias("slot"), F.get(names, F.col("id").cast("int")).alias("shard"))


def shard_rows(rows: DataFrame, turns: Mapping[str, int], key: str = "doc_id", slots: int = SLOTS,
               seed: object = "slots") -> DataFrame:
    """``rows`` as ``row`` (a struct of the input), ``key, slot, shard``.

    The key's md5 gives the slot, the slot's owner the shard; no shuffle, and a source that
    holds a third of the rows spreads like any other. Rows with one key share a shard, null
    keys go where the empty string goes, and texts are not read. An empty table gives an
    empty result. The broadcast table has ``slots`` rows, whatever the size of ``rows``.
    """
    table = F.broadcast(slot_table(rows.sparkSession, fill_slots(turns, slots, seed)))
    placed = rows.select(F.struct(*[rows[f"`{c}`"] for c in rows.columns]).alias("row"), rows[key].alias("key"),
                         (token_hash(f"{seed}:key", rows[key]) % slots).alias("slot"))
    return placed.join(table, "slot").select("row", "key", "slot", "shard")
