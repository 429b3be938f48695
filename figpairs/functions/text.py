"""Column expressions for the string rules of the pipeline.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's for identical results)
# ---------------------------------------------------------------------------
# Image member extensions, in candidate order.
IMAGE_EXTS = (".jpg", ".jpeg", ".png", ".tif", ".tiff")
# Article XML member extension.
XML_EXT = ".nxml"
# Package extension appended to catalogue paths.
PACKAGE_EXT = ".tar.gz"
# Split cut points on the md5 bucket 0..99: < 97 train, < 98 dev, else test.
SPLIT_CUTS = (97, 98)
SPLIT_NAMES = ("train", "dev", "test")
# Default rows per shard.
SHARD_SIZE = 10_000
# Default list-file prefix and the shard list name format (prefix, 5-digit index).
LIST_PREFIX = "pubmed_open_access_file_list"
SHARD_NAME_FORMAT = "%s_shard-%05d"
# Pair image path (pmcid, pmcid, fig_id) and pair id (pmid, fig_id) formats.
IMAGE_PATH_FORMAT = "%s/%s_fig-%s.jpg"
PAIR_ID_FORMAT = "%s_%s"
# Characters that Python's ``str.strip()`` removes (``str.isspace``).
PY_WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # regex class body
# ---------------------------------------------------------------------------

_WS_CLASS = "[" + PY_WHITESPACE + "]"
IMAGE_EXT_RE = r"\.(" + "|".join(e[1:] for e in IMAGE_EXTS) + r")\z"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()`` (no argument): strip Unicode whitespace both ends."""
    return F.regexp_replace(col_(c), f"^{_WS_CLASS}+|{_WS_CLASS}+$", "")


def split_tabs(c) -> Column:
    """``s.split('\\t')`` keeping trailing empty fields (limit -1)."""
    return F.split(col_(c), "\t", -1)


def basename(c) -> Column:
    """``pathlib.PurePosixPath(s).name``: last component that is not '' or '.'."""
    parts = F.filter(F.split(col_(c), "/", -1), lambda x: (x != "") & (x != "."))
    return F.coalesce(F.get(F.reverse(parts), 0), F.lit(""))


def stem(base) -> Column:
    """``PurePath(name).stem``: drop the last ``.suffix`` unless the only dot
    leads the name or ends it."""
    b = col_(base)
    return F.when(b.rlike(r"(?s)^.+\.[^.]+$"), F.regexp_replace(b, r"\.[^.]*$", "")).otherwise(b)


def parent_dir(c) -> Column:
    """Directory part of a path (``Path(p).parent`` for absolute/relative file paths)."""
    return F.regexp_replace(col_(c), r"/[^/]*$", "")


def is_image_name(c) -> Column:
    """Case-insensitive test for the image extensions."""
    return F.lower(col_(c)).rlike(IMAGE_EXT_RE)


def is_xml_name(c) -> Column:
    return F.lower(col_(c)).endswith(XML_EXT)


def md5_bucket(c, buckets: int = 100) -> Column:
    """``int(md5(s)[:8], 16) % buckets`` (first 32 bits of the digest)."""
    return F.pmod(F.conv(F.substring(F.md5(col_(c)), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def fmt05(c) -> Column:
    """``f'{i:05d}'`` (no truncation above 99999, unlike ``lpad``)."""
    return F.format_string("%05d", col_(c))


def nonempty_or(a, b) -> Column:
    """``a or b`` for strings: NULL and '' fall back to ``b``."""
    return F.coalesce(F.nullif(col_(a), F.lit("")), col_(b))


def normalize_pmcid(c) -> Column:
    """Bare-digit article ids get the ``PMC`` prefix (``"12345"`` → ``"PMC12345"``);
    anything else is kept."""
    x = col_(c)
    return F.when(x.rlike(r"^[0-9]+$"), F.concat(F.lit("PMC"), x)).otherwise(x)


def with_ext(c, ext: str = PACKAGE_EXT) -> Column:
    """Append ``ext`` unless the value already ends with it (case-sensitive)."""
    x = col_(c)
    return F.when(x.endswith(ext), x).otherwise(F.concat(x, F.lit(ext)))
