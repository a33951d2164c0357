"""Batch collation as one window over ``batch_id`` and array expressions.

A batch is ``batch_size`` consecutive rows by a dense position (never by
partition order).  Every per-batch reduction (longest label, shared start
token) is a window partitioned by ``batch_id``; a batch is at most
``batch_size`` rows, so no window partition can grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.operators.tokens import EOT, IGNORE, PAD, RESERVED, SOT, Reserved


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def assign_batches(df: DataFrame, idx: str = "idx", batch_size: int = 16) -> DataFrame:
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    return df.withColumn("batch_id", F.floor(F.col(idx) / batch_size).cast("bigint")).withColumn(
        "pos", (F.col(idx) % batch_size).cast("int")
    )


def batch_window() -> Window:
    return Window.partitionBy("batch_id")


def pad_to(arr, length: Column, fill) -> Column:
    """Right-pad ``arr`` with ``fill`` to ``length``."""
    a = _c(arr)
    gap = F.greatest(length - F.size(a), F.lit(0))
    return F.concat(a, F.array_repeat(F.lit(fill).cast("int"), gap))


def pad_labels(df: DataFrame, labels: str = "labels", fill: int = PAD, name: str | None = None) -> DataFrame:
    """Pad to the longest label of the batch."""
    longest = F.max(F.size(labels)).over(batch_window())
    return df.withColumn(name or labels, pad_to(labels, longest, fill))


def mask_padding(df: DataFrame, labels: str = "labels") -> DataFrame:
    """Pad with the ignore mark and carry the attention mask (1 = real, 0 = padding)."""
    longest = F.max(F.size(labels)).over(batch_window())
    ones = F.array_repeat(F.lit(1), F.size(labels))
    return df.withColumn("attention_mask", pad_to(ones, longest, 0)).withColumn(labels, pad_to(labels, longest, IGNORE))


def strip_shared_start(df: DataFrame, labels: str = "labels", start: int = SOT) -> DataFrame:
    """Drop column 0 only if every row of the batch begins with ``start``."""
    every = F.min(F.when(F.get(F.col(labels), 0) == start, 1).otherwise(0)).over(batch_window()) == 1
    return df.withColumn(labels, F.when(every, F.slice(labels, 2, F.greatest(F.size(labels) - 1, F.lit(0)))).otherwise(F.col(labels)))


def shift_labels(df: DataFrame, labels: str = "labels") -> DataFrame:
    """decoder_input_ids = all but the last; labels = all but the first."""
    n = F.size(labels)
    return df.withColumn("decoder_input_ids", F.slice(labels, 1, F.greatest(n - 1, F.lit(0)))).withColumn(
        labels, F.slice(labels, 2, F.greatest(n - 1, F.lit(0)))
    )


def mask_after_end(labels, end: int = EOT, length=None, compat: bool = False) -> Column:
    """Positions past the true ``length``, then those after the first end marker → ignore (the marker is kept).

    Without an end marker only padding is masked; ``compat`` masks every position
    after 0 instead, as an argmax over no match does.  Written with slices
    (no lambda) so the array is never re-evaluated per element.
    """
    a = _c(labels)
    n = F.size(a)
    real = n if length is None else F.least(_c(length).cast("int"), n)
    p = F.array_position(F.slice(a, 1, F.greatest(real, F.lit(0))), end).cast("int")  # 1-based, 0 when absent
    if compat:
        p = F.when(p == 0, F.lit(1)).otherwise(p)
    keep = F.greatest(F.when(p > 0, F.least(p, real)).otherwise(real), F.lit(0))
    masked = F.concat(F.slice(a, 1, keep), F.array_repeat(F.lit(IGNORE), F.greatest(n - keep, F.lit(0))))
    return F.when(n > 0, masked).otherwise(a)


def mask_prompt(labels, start: int = SOT) -> Column:
    """Positions before the first start marker → ignore; absent marker masks nothing."""
    a = _c(labels)
    s = F.array_position(a, start).cast("int")
    n = F.size(a)
    masked = F.concat(F.array_repeat(F.lit(IGNORE), F.greatest(s - 1, F.lit(0))), F.slice(a, F.greatest(s, F.lit(1)), F.greatest(n - s + 1, F.lit(0))))
    return F.when(s > 1, masked).otherwise(a)


def collate(df: DataFrame, idx: str = "idx", labels: str = "labels", batch_size: int = 16, compat: bool = False, reserved: Reserved = RESERVED) -> DataFrame:
    """Prompted-label collator: pad with pad id, shift, mask padding and what follows the end, mask the prompt.

    ``reserved`` names the pad, end and start ids of the vocabulary that made the labels.
    """
    b = assign_batches(df, idx, batch_size).withColumn("_real", F.size(labels) - 1)
    b = pad_labels(b, labels, reserved.pad)
    b = shift_labels(b, labels)
    ended = mask_after_end(labels, reserved.eot, "_real", compat)
    return b.withColumn(labels, mask_prompt(ended, reserved.sot)).drop("_real")


def collate_plain(df: DataFrame, idx: str = "idx", labels: str = "labels", batch_size: int = 16, reserved: Reserved = RESERVED) -> DataFrame:
    """Plain collator: pad with the ignore mark via the attention mask, strip a shared start column."""
    b = assign_batches(df, idx, batch_size)
    b = mask_padding(b, labels)
    return strip_shared_start(b, labels, reserved.sot)


def pad_features(df: DataFrame, features: str = "input_features", fill: float = 0.0) -> DataFrame:
    """Feature arrays right-padded with ``fill`` to the longest of the batch (no-op on fixed shapes)."""
    longest = F.max(F.size(features)).over(batch_window())
    gap = F.greatest(longest - F.size(features), F.lit(0))
    return df.withColumn(features, F.concat(F.col(features), F.array_repeat(F.lit(fill).cast("float"), gap)))


def forward_mask(df: DataFrame, features: str = "input_features", model_kind: str = "whisper", spec_augment: bool = True, mask_time_prob: float = 0.05) -> DataFrame:
    """Carry a frame-level attention mask only when model kind, augmentation and mask probability all ask for it."""
    if model_kind == "whisper" and spec_augment and mask_time_prob > 0:
        return df.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size(features)))
    return df
