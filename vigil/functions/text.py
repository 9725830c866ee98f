"""Path algebra, stable ids, payload codec guard, token windows (OP-30, OP-31, OP-39, OP-47)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- path algebra (OP-30) ----------------------------------------------------------

def url_path(url: Column | str) -> Column:
    """Path part of a URL (query and fragment removed); a bare path is returned as is."""
    url = _c(url)
    no_tail = F.regexp_extract(url, r"^([^?#]*)", 1)
    return F.when(no_tail.contains("://"), F.regexp_extract(no_tail, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(.*)$", 1)) \
        .otherwise(no_tail)


def url_host(url: Column | str) -> Column:
    return F.regexp_extract(_c(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)


def path_segment(path: Column | str, i: int) -> Column:
    """1-based non-empty path segment (negative counts from the end); '' if absent."""
    segs = F.filter(F.split(_c(path), "/"), lambda s: s != "")
    return F.coalesce(F.try_element_at(segs, F.lit(i)), F.lit(""))


def file_name(path: Column | str) -> Column:
    return F.substring_index(_c(path), "/", -1)


def file_stem(path: Column | str) -> Column:
    name = file_name(path)
    return F.when(name.contains("."), F.regexp_extract(name, r"^(.*)\.[^.]*$", 1)).otherwise(name)


def file_ext(path: Column | str) -> Column:
    """Lower-cased extension with the dot ('.mp4'), '' when there is none."""
    return F.lower(F.regexp_extract(file_name(path), r"(\.[^.]*)$", 1))


def parent_dir(path: Column | str) -> Column:
    return F.regexp_extract(_c(path), r"^(.*)/[^/]*$", 1)


def manifest_key(label: Column | str, path: Column | str) -> Column:
    """``{label}_{stem}`` as the original manifest writer names its entries."""
    return F.concat_ws("_", _c(label), file_stem(path))


# --- stable id (OP-31) -------------------------------------------------------------

def stable_id(split: Column | str, url: Column | str) -> Column:
    """sha256 of ``split:url``: identical on every replay, unique across splits."""
    return F.sha2(F.concat_ws(":", _c(split), _c(url)), 256)


# --- payload codec (OP-39) ---------------------------------------------------------

def b64encode(binary: Column | str) -> Column:
    """Base64 text of bytes, one line (Spark's encoder inserts CRLF every 76 chars)."""
    return F.translate(F.base64(_c(binary)), "\r\n", "")


def b64decode_guarded(text: Column | str) -> Column:
    """Bytes, or null when the text is not valid base64 (never silently empty)."""
    return F.try_to_binary(_c(text), F.lit("base64"))


def payload_status(text: Column | str) -> Column:
    text = _c(text)
    decoded = b64decode_guarded(text)
    return (F.when(text.isNull() | (F.length(text) == 0), F.lit("empty"))
            .when(decoded.isNull(), F.lit("decode_error"))
            .otherwise(F.lit("ok")))


# --- tokens (OP-47) ----------------------------------------------------------------

def tokens(text: Column | str) -> Column:
    """Single-space tokenisation of the whole text (lower-cased)."""
    return F.split(F.lower(F.coalesce(_c(text), F.lit(""))), " ")


def token_window(text: Column | str, length: int, pad: str = "") -> Column:
    """Model input window: the first ``length`` tokens, right-padded with ``pad``."""
    t = tokens(text)
    return F.slice(F.concat(t, F.array_repeat(F.lit(pad), length)), 1, length)


def word_lengths(text: Column | str, most: int | None = None) -> Column:
    """Per-word character counts over the whole text (the 'series' modality), or of its first ``most`` words."""
    whole = F.coalesce(_c(text), F.lit(""))
    words = F.split(whole, " ") if most is None else F.slice(F.split(whole, " ", most + 1), 1, most)
    return F.transform(words, lambda w: F.length(w))
