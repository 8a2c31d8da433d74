"""Conversations rolled up from their messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import fixed
from docloom.functions import text as X


def conversation_key(conversation_id: Column, subject: Column, entry_id: Column) -> Column:
    """The conversation's id, else its subject without prefixes, else the message alone."""
    key = X.subject_key(subject)
    return F.coalesce(
        F.nullif(conversation_id, F.lit("")),
        F.when(key != fixed.NO_THREAD_SUBJECT, F.concat(F.lit("SUBJ_"), X.thread_key(key))),
        F.concat(F.lit("ITEM_"), entry_id),
    )


def rollup(messages: DataFrame, key: str, order: str, sender: str, text: str) -> DataFrame:
    """One row per conversation: counts, first and last order and text, sorted distinct senders."""
    return messages.groupBy(key).agg(
        F.count("*").alias("n_messages"),
        F.min(order).alias("first"),
        F.max(order).alias("last"),
        F.min_by(text, order).alias("first_text"),
        F.max_by(text, order).alias("last_text"),
        F.array_sort(F.collect_set(sender)).alias("senders"),
    )


def documents(messages: DataFrame, key: str, order: str) -> DataFrame:
    """The messages of each conversation in order, as an array of structs (a conversation fits a row by nature)."""
    rest = [c for c in messages.columns if c not in (key, order)]
    return messages.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *rest))).alias("messages"))


def mailbox(items: DataFrame, *, kind: str, received: str, limit: int = 150) -> DataFrame:
    """Mail items alone (class 43), the newest first, capped: a top-k, no full sort."""
    return items.where(F.col(kind) == 43).orderBy(F.col(received).desc()).limit(limit)
