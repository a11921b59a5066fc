"""Names, relative paths and their checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.functions.binding import bound

MAX_BYTES = 220
RAW_ROOT = "_raw/all/"
#: Hex of a UTF-8 prefix that ends within a character: what stands before the incomplete one.
_WHOLE = r"\A((?:[0-9A-F]{2})*?)(?:[CD][0-9A-F]|E[0-9A-F](?:[89AB][0-9A-F])?|F[0-9A-F](?:[89AB][0-9A-F]){0,2})\z"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)([^/]*)\z", 1)


def stem(name: Column) -> Column:
    """Without the last suffix; leading dots are no suffix."""
    return F.regexp_replace(name, r"(?s)\A(.*/)?(\.*[^./][^/]*)\.[^./]*\z", "$1$2")


def suffix(name: Column) -> Column:
    """The last suffix with its dot, or ''."""
    return bound(name, lambda n: F.substring(n, F.length(stem(n)) + 1, F.length(n)))


def extension(name: Column) -> Column:
    return F.lower(suffix(name))


def flat(path: Column) -> Column:
    return F.replace(path, F.lit("/"), F.lit("__"))


def forward(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def bounded(stem_: Column, ending: str, identity: Column, most: int = MAX_BYTES) -> Column:
    """The name, cut to ``most`` UTF-8 bytes and marked by a hash of the identity if it is longer."""
    tail = F.concat(F.lit("."), F.substring(F.sha2(identity.cast("binary"), 256), 1, 12), F.lit(ending))

    def cut_to(stem_: Column) -> Column:
        cut = F.substring(F.hex(F.encode(stem_, "UTF-8")), 1, 2 * (most - 13 - len(ending)))
        prefix = F.decode(F.unhex(F.regexp_replace(cut, _WHOLE, "$1")), "UTF-8")
        prefix = F.regexp_replace(prefix, r"[ .]+\z", "")
        longer = bound(prefix, lambda p: F.concat(F.when(p == "", "file").otherwise(p), tail))
        whole = F.concat(stem_, F.lit(ending))
        return F.when(F.octet_length(whole) <= most, whole).otherwise(longer)

    return bound(stem_, cut_to)


def _short_hash(path: Column) -> Column:
    return F.substring(F.sha2(path.cast("binary"), 256), 1, 10)


def raw_name(rel: Column) -> Column:
    """Name of a source's text in the archive: flat, and with a short hash if it was nested."""

    def of(path: Column) -> Column:
        name = F.when(F.contains(path, F.lit("/")), F.concat(flat(path), F.lit("."), _short_hash(path))).otherwise(path)
        return bounded(name, ".txt", path)

    return bound(forward(rel), of)


def raw_path(rel: Column) -> Column:
    return F.concat(F.lit(RAW_ROOT), raw_name(rel))


def md_name(rel: Column, name: Column) -> Column:
    """Name of a document in the library.

    With a relative path the suffix stays in the name, and nested paths are flat with a short hash; old
    records without one keep the bare stem.
    """

    def of(x: Column) -> Column:
        path, nested, own = x["path"], x["nested"], x["own"]
        end = F.regexp_replace(suffix(own), r"\A\.+", "")
        full = F.when(end != "", F.concat(stem(own), F.lit("."), end)).when(suffix(own) != "", F.concat(stem(own), F.lit("."))).otherwise(stem(own))
        marked = F.when(nested, F.concat(full, F.lit("."), _short_hash(path))).otherwise(full)
        return F.when(path.isNull(), bounded(stem(own), ".md", x["name"])).otherwise(bounded(marked, ".md", path))

    def parts(x: Column) -> Column:
        nested = F.coalesce(F.contains(x["path"], F.lit("/")), F.lit(False))
        own = F.when(nested, flat(x["path"])).otherwise(base_name(forward(x["name"])))
        return bound(F.struct(x["path"].alias("path"), x["name"].alias("name"), nested.alias("nested"), own.alias("own")), of)

    return bound(F.struct(forward(F.when(rel != "", rel)).alias("path"), name.alias("name")), parts)


def key(rel: Column, name: Column) -> Column:
    return F.coalesce(F.when(rel != "", rel), name)


def safe(path: Column) -> Column:
    """True for a relative path that can't leave its root: no drive, root, empty or dotted component, NUL."""

    def good(p: Column) -> Column:
        return p.isNotNull() & ~(F.contains(p, F.lit("\0")) | p.rlike(r"\A/|\A[A-Za-z]:|\A\z") | p.rlike(r"(?s)(\A|/)(\.{0,2})(/|\z)"))

    return bound(forward(path), good)


def reserved(category: Column) -> Column:
    """True for a category in the archive's own folder."""
    return F.lower(F.split_part(forward(category), F.lit("/"), F.lit(1))) == "_raw"
