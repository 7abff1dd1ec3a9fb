"""Reference ids (queue:x, bot:x, system:x) as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns of the stored references: a typed one, the prefixes of old ones, a queue that another thing owns.
_TYPED = "(?i)(system|queue|bot):(.*)"
_OLD = "^[seb]_"
_OWNED = "^(bot|system)\\.(.*?)(?:\\.(.*))?$"


def ref_type(ref: Column, default: str = "queue") -> Column:
    return F.when(ref.rlike(_TYPED), F.lower(F.regexp_extract(ref, _TYPED, 1))).otherwise(default)


def ref_name(ref: Column) -> Column:
    return F.when(ref.rlike(_TYPED), F.regexp_extract(ref, _TYPED, 2)).otherwise(F.regexp_replace(ref, _OLD, ""))


def ref_id(ref: Column, default: str = "queue") -> Column:
    """type:name, with the old one-letter prefixes removed."""
    return F.concat(ref_type(ref, default), F.lit(":"), ref_name(ref))


def as_queue(ref: Column, sub: Column | str | None = None, default: str = "queue") -> Column:
    """The queue that a reference stands for: type.name for what isn't a queue, and .sub for a sub-queue."""
    kind, name = ref_type(ref, default), ref_name(ref)
    other = F.concat(kind, F.lit("."), F.when(name.startswith(F.concat(kind, F.lit("."))), F.substr(name, F.length(kind) + 2)).otherwise(name))
    base = F.when(kind == "queue", name).otherwise(other)
    return base if sub is None else F.concat(base, F.lit("."), F.lit(sub) if isinstance(sub, str) else sub)


def owner(queue: Column) -> Column:
    """bot:x or system:x for a queue named bot.x[...] or system.x[...], else null."""
    return F.when(queue.rlike(_OWNED), F.concat(F.regexp_extract(queue, _OWNED, 1), F.lit(":"), F.regexp_extract(queue, _OWNED, 2)))
