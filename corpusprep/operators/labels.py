"""Training label assembly: previous-text prompt, timestamp/plain choice, prompt attachment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusprep.functions.draws import draw, threshold
from corpusprep.operators.tokens import MAX_LENGTH, MAX_PROMPT_LENGTH, RESERVED, Reserved

TIMESTAMP_PROBABILITY = 0.8  # fixed values: collator defaults
PROMPT_PROBABILITY = 0.7


def prompt_ids(ids, max_length: int = MAX_PROMPT_LENGTH, reserved: Reserved = RESERVED) -> Column:
    """Start-of-prev + the last ``max_length - 1`` ids (left truncation)."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    keep = max_length - 1
    start = F.greatest(F.size(ids) - (keep - 1), F.lit(1))
    return F.concat(F.array(F.lit(reserved.sop)), F.slice(ids, start, keep))


def choose_target(plain, stamped, flag, u: Column, p: float = TIMESTAMP_PROBABILITY) -> Column:
    """Timestamp ids when the draw falls under ``p`` and the row is eligible, else plain ids."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.when((u < F.lit(threshold(p))) & c(flag), c(stamped)).otherwise(c(plain))


def attach_prompt(
    prompt, target, u: Column, p: float = PROMPT_PROBABILITY, max_length: int = MAX_LENGTH, compat: bool = False, reserved: Reserved = RESERVED
) -> Column:
    """Prompt + target when it fits, the draw says so, and the prompt is real and not silence.

    The silence test looks at the first id after start-of-prev; ``compat``
    looks at element 0 as the reference does, which is always start-of-prev,
    so that test never fires.
    """
    c = lambda x: F.col(x) if isinstance(x, str) else x
    pr, tg = c(prompt), c(target)
    fits = (F.size(pr) + F.size(tg)) <= max_length
    real = F.size(pr) > 1
    probe = F.get(pr, 0) if compat else F.get(pr, 1)
    silent = F.coalesce(probe == reserved.no_speech, F.lit(False))
    use = fits & (u < F.lit(threshold(p))) & real & ~silent
    return F.when(use, F.concat(pr, tg)).otherwise(tg)


def row_draw(seed: int, purpose: str, epoch: int, *keys) -> Column:
    """Default draw: per (seed, epoch, row), so every row gets its own choice in every epoch."""
    return draw(seed, purpose, F.lit(epoch), *keys)


def batch_position_draw(seed: int, purpose: str, pos) -> Column:
    """Compat draw: the reference reseeds at every batch, so a choice depends only on the
    row's position inside its batch (the same positions choose alike in every batch and epoch)."""
    return draw(seed, purpose, pos)
