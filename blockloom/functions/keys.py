"""Column functions over row keys, cell qualifiers and file paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from blockloom.model import QUALIFIER_BIN, QUALIFIER_PROTO, RANGE_PATTERN, SOURCE_TABLES


def slot_to_key(slot: Column) -> Column:
    """16 lower-case hex digits, so text order equals slot order."""
    return F.lower(F.lpad(F.hex(slot), 16, "0"))


def key_to_slot(key: Column) -> Column:
    """Slot of a hex key; null when the text is no hex number or does not fit a LONG.

    ``conv`` reads up to the first bad digit, so the guard has to reject bad text first.
    """
    is_hex = key.rlike(r"^0*[0-9a-fA-F]{1,16}\z")
    return F.when(is_hex, F.conv(key, 16, 10).try_cast("bigint"))


def is_slot_key(key: Column) -> Column:
    """Whether ``key`` is what ``slot_to_key`` makes of some slot that is not negative."""
    return key.rlike(r"^[0-7][0-9a-f]{15}\z")


def inverted_key(slot: Column) -> Column:
    """Hex of the bitwise complement: an ascending scan meets the newest slot first."""
    return slot_to_key(F.bitwise_not(slot))


def address_slot_key(address: Column, slot: Column) -> Column:
    return F.concat(address, F.lit("/"), inverted_key(slot))


def payload_format(qualifier: Column) -> Column:
    """Layout named by the first letter of a qualifier; null for any other text."""
    return F.when(qualifier.startswith("p"), F.lit(QUALIFIER_PROTO)).when(
        qualifier.startswith("b"), F.lit(QUALIFIER_BIN)
    )


def _path_part(path: Column, position: int) -> Column:
    """A path segment counted from the end; ``name=value`` folders count as ``value``."""
    part = F.try_element_at(F.split(path, "/"), F.lit(position))
    return F.regexp_replace(part, "^[^=]*=", "")


def file_stem(path: Column) -> Column:
    """File name without its last extension."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


def parent_folder(path: Column) -> Column:
    return _path_part(path, -2)


def folder_below(path: Column, root: str) -> Column:
    """First folder of ``path`` below ``root``. A path elsewhere is an error.

    ``scheme:///`` and ``scheme:/`` are one; a root without a scheme matches paths of any.
    """
    root = re.sub(r"^(\w+):///", r"\1:/", root.rstrip("/") + "/")
    spelt = F.regexp_replace(path, r"^(\w+):///", "$1:/")
    if ":" not in root.split("/")[0]:
        spelt = F.regexp_replace(spelt, r"^\w+:(//[^/]*)?", "")
    below = F.substring(spelt, F.lit(len(root) + 1), F.length(spelt))
    first = F.regexp_replace(F.split(below, "/")[0], "^[^=]*=", "")
    foreign = F.raise_error(F.concat(F.lit(f"not below {root}: "), path)).cast("string")
    return F.when(spelt.startswith(root), first).otherwise(foreign)


def range_start_key(path: Column) -> Column:
    """First hex bound of a range name anywhere in the path; empty text without one."""
    return F.regexp_extract(path, RANGE_PATTERN, 1)


def range_end_key(path: Column) -> Column:
    return F.regexp_extract(path, RANGE_PATTERN, 2)


def range_name(start_key: Column, end_key: Column) -> Column:
    return F.concat(F.lit("range_"), start_key, F.lit("_"), end_key)


def kinds_of(path: Column) -> Column:
    """Source tables whose name occurs in the path; the tests are independent of each other."""
    kinds = F.array(*[F.lit(kind) for kind in SOURCE_TABLES])
    return F.filter(kinds, lambda kind: F.contains(path, kind))
