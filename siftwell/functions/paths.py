"""Repository-relative paths and directory prefixes."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value worked out once however often f mentions it.  Else its expression is repeated for each, until generated code is too long to be compiled."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _is_plain(path: Column, name: str) -> Column:
    """Whether a path holds nothing that normalize_file_path() changes, by searches that cost far less than its expressions; false for null."""
    odd = path.contains("\\") | path.contains("//") | path.startswith("/") | path.startswith("./") | (F.substring(path, 2, 1) == ":") | F.substring(path, 1, 1).rlike(r"\s") | F.substring(path, -1, 1).rlike(r"\s")
    if name:
        odd = odd | F.lower(path).contains(f"/{name.lower()}/")
    return F.coalesce(~odd, F.lit(False))


def normalize_file_path(path: Column, repo_name: str = "") -> Column:
    """The path below the repository; null gives the empty path.

    Backslashes become slashes, a drive letter goes, everything through the last /repo_name/ goes (any case), then
    leading slashes, one ./ and doubled slashes.
    """
    return _once(path, lambda p: F.when(_is_plain(p, repo_name.strip().strip("/")), p).otherwise(_normalized(p, repo_name)))


def _normalized(path: Column, repo_name: str) -> Column:
    text = _stripped(F.translate(F.coalesce(path, F.lit("")), "\\", "/"))
    text = F.regexp_replace(text, "^.:", "")
    name = repo_name.strip().strip("/")
    if name:
        quoted = "".join(c if c.isalnum() or c == "_" else f"\\{c}" for c in name)
        text = F.regexp_replace(text, f"(?is)^.*/{quoted}/", "")
    text = F.regexp_replace(F.regexp_replace(text, "^/+", ""), r"^\./", "")
    return F.regexp_replace(text, "/+", "/")


def exclude_prefix(prefix: str) -> str:
    """A directory prefix as written by a user, relative to the repository and without slashes around it."""
    text = re.sub(r"^(\./)+", "", prefix.strip().replace("\\", "/")).strip("/")
    return re.sub("/{2,}", "/", text)


def exclude_prefixes(prefixes: Iterable[str]) -> list[str]:
    """Distinct nonempty prefixes, in the order given."""
    return list(dict.fromkeys(p for p in map(exclude_prefix, prefixes) if p))


def as_prefix(path: Column) -> Column:
    """exclude_prefix for a column."""
    text = F.regexp_replace(_stripped(F.translate(F.coalesce(path, F.lit("")), "\\", "/")), r"^(\./)+", "")
    return F.regexp_replace(F.regexp_replace(text, "^/+|/+$", ""), "/+", "/")


def is_excluded(path: Column, prefixes: Iterable[str]) -> Column:
    """Whether a normalised path is one of the directories, or lies below one."""
    names = exclude_prefixes(prefixes)

    def below(place: Column) -> Column:
        return reduce(Column.__or__, [(place == p) | place.startswith(f"{p}/") for p in names])

    def excluded(x: Column) -> Column:
        # as_prefix() leaves the names between slashes, so a path without the first of one's names needs no expressions
        near = reduce(Column.__or__, [x.contains(p.split("/")[0]) for p in names])
        return F.when(near, _once(as_prefix(x), below)).otherwise(False)

    return _once(F.coalesce(path, F.lit("")), excluded) if names else F.lit(False)


def location_key(path: Column, line: Column, end_line: Column) -> Column:
    """path:line-end, with the line for a missing end and 0 for a missing line."""
    first = F.coalesce(line, F.lit(0))
    return F.concat(path, F.lit(":"), first.cast("string"), F.lit("-"), F.coalesce(end_line, first).cast("string"))


def repo_relative(path: Column, root: str) -> Column:
    """The path below a checkout's root; other paths stay."""
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, F.lit(len(base) + 1), F.length(path))).otherwise(path)


def safe_path(path: Column) -> Column:
    """Null for absolute paths and those that leave their root by .. segments."""
    text = F.translate(path, "\\", "/")
    bad = text.startswith("/") | text.rlike(r"(^|/)\.\.(/|$)") | text.rlike("^.:")
    return F.when(~bad, text)
