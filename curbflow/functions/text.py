"""Tag text: the comparison key, the usable-tag test and the stored hash."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the tag rules.
NO_TAG = "-1"
MAX_TAG_LENGTH = 30


def tag_key(tag: Column) -> Column:
    """Key under which two tags are the same: case and trailing blanks do not count."""
    return F.upper(F.rtrim(tag))


def is_untagged(tag: Column) -> Column:
    """True for pings without a tag; never null."""
    return tag.isNull() | (F.rtrim(tag) == NO_TAG) | (F.trim(tag) == "")


def is_usable_tag(tag: Column) -> Column:
    """True for tags that can be matched; a longer tag is neither usable nor untagged."""
    return ~is_untagged(tag) & (F.length(F.rtrim(tag)) <= MAX_TAG_LENGTH)


def tag_hash(tag: Column) -> Column:
    """SHA-256 of the tag as two-byte little-endian text, in hex."""
    return F.sha2(F.encode(tag, "UTF-16LE"), 256)
