"""Identifiers, file paths and text parts derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SINGLE_STRANDED_SUFFIX = "_ss"


def canonical_id(full: Column, main: Column, null_main_is_missing: bool = False) -> Column:
    """Main ID if there is one, else the full ID.

    An empty main ID means "none". A NULL main ID is unknown and gives NULL unless
    ``null_main_is_missing`` asks for the full ID there too.
    """
    chosen = F.when(main == "", full).otherwise(main)
    return F.coalesce(chosen, full) if null_main_is_missing else chosen


def rebase_path(path: Column, old: str, new: str) -> Column:
    """Replace a leading ``old`` storage prefix by ``new``; other paths stay."""
    rest = F.substr(path, F.lit(len(old) + 1))
    return F.when(path.startswith(old), F.concat(F.lit(new), rest)).otherwise(path)


def read_file_path(directory: Column, sequencing_id: Column, extension: str = ".bam") -> Column:
    """Path of the read file of one sequencing; NULL if either part is NULL."""
    return F.concat(directory, sequencing_id, F.lit(extension))


def single_stranded_name(name: Column, flag: Column) -> Column:
    """Sample name, suffixed where the single-stranded flag says yes."""
    suffixed = F.concat(name, F.lit(SINGLE_STRANDED_SUFFIX))
    return F.when(flag == "yes", suffixed).otherwise(name)


def single_stranded_library(library: Column, flag: Column) -> Column:
    """Library ID with the suffix put before its first dot where the flag says yes."""
    infixed = F.regexp_replace(library, r"^([^.]*)\.", f"$1{SINGLE_STRANDED_SUFFIX}.")
    return F.when(flag == "yes", infixed).otherwise(library)


def dots_to_underscores(text: Column) -> Column:
    return F.translate(text, ".", "_")


def site_id(identifier: Column) -> Column:
    """Site code: the leading letters of an individual or sample ID, however many there are."""
    return F.regexp_extract(identifier, "^([A-Za-z]+)", 1)


def before_first_dot(identifier: Column) -> Column:
    """Individual part of a sequencing or library ID."""
    return F.substring_index(identifier, ".", 1)


def individual_id(identifier: Column, keep_suffix: bool = False) -> Column:
    """Individual of a sample or sequencing ID, without the single-stranded suffix."""
    first = before_first_dot(identifier)
    return first if keep_suffix else F.regexp_replace(first, f"{SINGLE_STRANDED_SUFFIX}$", "")


def path_part(path: Column, position: int) -> Column:
    """The ``position``-th part of a path (from 1), or from the end if negative; NULL if absent."""
    return F.try_element_at(F.split(path, "/"), F.lit(position))


def base_name(path: Column, extension: str = "") -> Column:
    """Last part of a path without the given extension."""
    last = path_part(path, -1)
    if not extension:
        return last
    cut = F.substr(last, F.lit(1), F.length(last) - len(extension))
    return F.when(last.endswith(extension), cut).otherwise(last)


def first_group(groups: Column, separator: str = ";") -> Column:
    """First of several group names."""
    return F.substring_index(groups, separator, 1)


def group_from_id(sample: Column, digits: int = 3) -> Column:
    """Group label: the sample ID without its trailing number (and suffix, if it has one)."""
    extra = len(SINGLE_STRANDED_SUFFIX)
    tail = F.when(sample.endswith(SINGLE_STRANDED_SUFFIX), digits + extra).otherwise(digits)
    return F.substr(sample, F.lit(1), F.greatest(F.length(sample) - tail, F.lit(0)))


def clean_library_names(names: Column, anchored: bool = False) -> Column:
    """Library names without the single-stranded suffix, each kept once, in sorted order.

    Every occurrence of the suffix goes; ``anchored`` removes only the one before the first dot
    (or at the end of a name without dots).
    """
    if anchored:
        pattern, replacement = r"^([^.]*?)_ss(\.|$)", "$1$2"
    else:
        pattern, replacement = SINGLE_STRANDED_SUFFIX, ""
    cleaned = F.transform(names, lambda name: F.regexp_replace(name, pattern, replacement))
    return F.array_sort(F.array_distinct(cleaned))


def squeeze_blanks(text: Column) -> Column:
    return F.regexp_replace(text, " +", " ")


def date_stamp(moment: Column | None = None, pattern: str = "yyMMdd_HHmm") -> Column:
    """Stamp text of a moment (default: the time the job starts)."""
    return F.date_format(F.current_timestamp() if moment is None else moment, pattern)
