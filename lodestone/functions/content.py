"""Content addresses and byte splices. Offsets are bytes, so texts are spliced as binary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def little_endian(n: Column) -> Column:
    """A non-negative number as eight bytes, least first."""
    h = F.lpad(F.hex(n), 16, "0")
    return F.unhex(F.concat(*[F.substring(h, i, 2) for i in range(15, 0, -2)]))


def trial_id(file_sha: Column, operator: Column, start: Column, end: Column, after: Column) -> Column:
    """The first 16 hex digits of SHA-256 over file digest, operator, offsets and replacement."""
    return F.substring(F.sha2(F.concat(file_sha.cast("binary"), operator.cast("binary"), little_endian(start), little_endian(end), after.cast("binary")), 256), 1, 16)


def splice(data: Column, start: Column, end: Column, after: Column) -> Column:
    head = F.substring(data, F.lit(1), start.cast("int"))
    tail = F.substring(data, (end + 1).cast("int"), F.greatest(F.octet_length(data) - end, F.lit(0)).cast("int"))
    return F.concat(head, after.cast("binary"), tail)


def splice_two(data: Column, a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    """Both sites, the later first; null where they overlap."""
    hi = lambda i: F.when(a[0] >= b[0], a[i]).otherwise(b[i])
    lo = lambda i: F.when(a[0] >= b[0], b[i]).otherwise(a[i])
    both = splice(splice(data, hi(0), hi(1), hi(2)), lo(0), lo(1), lo(2))
    return F.when(lo(1) <= hi(0), both)


def span_holds(data: Column, start: Column, end: Column, before: Column) -> Column:
    """Whether the bytes at a site are what it says."""
    return (end <= F.octet_length(data)) & (F.substring(data, (start + 1).cast("int"), (end - start).cast("int")) == before.cast("binary"))


def pair_key(a_file: Column, a_start: Column, a_op: Column, b_file: Column, b_start: Column, b_op: Column) -> Column:
    """The same for either order of two sites."""
    a, b = F.concat_ws(":", a_file, a_start, a_op), F.concat_ws(":", b_file, b_start, b_op)
    return F.concat(F.least(a, b), F.lit("|"), F.greatest(a, b))


def affinity(a_file: Column, a_scope: Column, b_file: Column, b_scope: Column) -> Column:
    return F.when(a_file != b_file, "cross-file").when(a_scope == b_scope, "same-scope").otherwise("same-file")
