"""String, number and array expressions; all are built-in column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BREAK = r"\s+"


def words(text: Column) -> Column:
    """Words between white space; none for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def tail(path: Column, sep: str = "/", back: int = 1) -> Column:
    """The ``back``-th part of a path from its end; null if there are fewer."""
    return F.try_element_at(F.split(path, f"[{sep}]"), F.lit(-back))


def extension(path: Column) -> Column:
    return F.when(F.contains(tail(path), F.lit(".")), tail(tail(path), "."))


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(tail(path), r"\.[^.]*$", "")


def directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def speaker_of(path: Column) -> Column:
    """The file name up to its first hyphen."""
    return F.substring_index(tail(path), "-", 1)


def is_remote(path: Column) -> Column:
    return path.startswith("s3://") | path.startswith("gs://")


def utterance_name(*parts: Column) -> Column:
    """Parts joined by a hyphen, spaces and slashes as underscores."""
    return F.translate(F.concat_ws("-", *parts), " /", "__")


def file_key(name: Column, longest: int = 236, kept: int = 172) -> Column:
    """A key that can be a file name: separators written out, long ones cut and ended by their digest."""
    key = F.replace(F.replace(F.replace(name, F.lit("/"), F.lit("_SLASH_")), F.lit("."), F.lit("_DOT_")), F.lit(" "), F.lit("_SPACE_"))
    return F.when(F.length(key) < longest, key).otherwise(F.concat(F.substring(key, 1, kept), F.sha2(key.cast("binary"), 256)))


def chunk_names(key: Column, n: Column, suffix: str) -> Column:
    """``key_00000.suffix`` and so on, ``n`` of them; longer names than a file system takes are an error."""
    names = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)).cast("int")), lambda i: F.format_string(f"%s_%05d.{suffix}", key, i))).otherwise(F.array().cast("array<string>"))
    return F.when(F.exists(names, lambda x: F.length(x) >= 256), F.raise_error(F.lit("chunk name too long")).cast("array<string>")).otherwise(names)


def licence_class(url: Column) -> Column:
    """The first kind that the address names; null for null."""
    # Address part and class, tested in this order.
    kinds = (("government-works", "US Government Works"), ("publicdomain", "Public Domain"), ("by-sa", "CC BY-SA"), ("by", "CC BY"))
    out = F.when(url.isNull(), F.lit(None).cast("string"))
    for part, name in kinds:
        out = out.when(url.contains(part), F.lit(name))
    return out.otherwise(F.lit("Unknown"))


def starred(*cols: Column, sep: str = " ") -> Column:
    """Columns joined, nulls as stars."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("*")) for c in cols])


def clean_transcript(text: Column, keep_dashes: bool = False, alphabet: str = " 'abcdefghijklmnopqrstuvwxyz") -> Column:
    """Lower case, dashes as spaces, runs of white space as one space, then only characters of the alphabet.

    White space goes together before other characters go, so two spaces can be left where one went between them.
    """
    low = F.lower(text)
    low = low if keep_dashes or "-" in alphabet else F.replace(low, F.lit("-"), F.lit(" "))
    members = "".join("\\" + c if c in "\\]^-[" else c for c in alphabet)
    return F.regexp_replace(F.trim(F.regexp_replace(low, WORD_BREAK, " ")), f"[^{members}]", "")


def srt_text(content: Column) -> Column:
    """What is said in SubRip cues, joined by spaces; empty for text that holds no cue."""
    unix = F.regexp_replace(F.regexp_replace(content, "^﻿", ""), "\r\n?", "\n")
    cues = F.regexp_extract_all(F.concat(unix, F.lit("\n\n")), F.lit(r"\d+[ \t]*\n[ \t]*\d+:\d+:\d+[,.]\d+[ \t]*-->[^\n]*\n((?:[^\n]*\S[^\n]*\n)*)"), F.lit(1))
    return F.array_join(F.filter(F.transform(cues, lambda c: F.replace(F.rtrim(F.regexp_replace(c, r"\n+$", "")), F.lit("\n"), F.lit(" "))), lambda c: c != ""), " ")


def guess_text(content: Column) -> Column:
    """Bytes as text: UTF-8 where they are valid, else Latin-1."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.decode(content, "ISO-8859-1"))


def repaired(text: Column) -> Column:
    """UTF-8 that was read as Latin-1, read again: where all characters are Latin-1 and their bytes are UTF-8 with fewer characters."""
    raw = F.encode(F.regexp_replace(text, "[^\x00-\xFF]", "?"), "ISO-8859-1")
    back = raw.cast("string")
    return F.when(text.rlike("^[\\x00-\\xFF]*$") & F.is_valid_utf8(back) & (F.length(back) < F.length(text)), back).otherwise(text)


def html_text(html: Column) -> Column:
    """Text of a page: no scripts, styles or tags; trimmed pieces, none empty, one a line."""
    bare = F.regexp_replace(F.replace(html, F.lit("\x00"), F.lit("")), "(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    bare = F.regexp_replace(bare, "<[^<]+?>", "\n")
    pieces = F.split(bare, r"\n|  ")
    return F.array_join(F.filter(F.transform(pieces, lambda p: F.trim(F.regexp_replace(p, r"\s+", " "))), lambda p: p != ""), "\n")


def plain(text: Column, lower: bool = True) -> Column:
    """ASCII, one line: accents folded, other characters dropped."""
    accents, letters = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ", "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"
    out = F.regexp_replace(F.translate(F.replace(text, F.lit("ß"), F.lit("ss")), accents, letters), r"[^\x00-\x7F]", "")
    out = F.trim(F.regexp_replace(out, WORD_BREAK, " "))
    return F.lower(out) if lower else out


def ngrams(text: Column, n: int) -> Column:
    """Character n-grams from the left; a shorter text has none."""
    return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def word_ngrams(w: Column, n: int) -> Column:
    """Word n-grams joined by spaces; ``w`` should be a column, not an expression, which each n-gram would evaluate anew."""
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))


def spelled(word: Column) -> Column:
    """A word's characters."""
    return F.when(F.length(word) > 0, F.regexp_extract_all(word, F.lit("(?s)(.)"), F.lit(1))).otherwise(F.array().cast("array<string>"))


def byte_size(text: Column) -> Column:
    """``1GB`` and the like as a number of bytes; powers of 1024; null if it is none."""
    unit = F.upper(F.regexp_extract(text, r"^\s*[0-9.]+\s*([kKmMgGtT]?)[bB]?\s*$", 1))
    number = F.regexp_extract(text, r"^\s*([0-9.]+)\s*[kKmMgGtT]?[bB]?\s*$", 1).try_cast("double")
    power = F.when(unit == "K", 1).when(unit == "M", 2).when(unit == "G", 3).when(unit == "T", 4).otherwise(0)
    return (number * F.pow(F.lit(1024.0), power)).cast("long")


def clock_ms(text: Column) -> Column:
    """``H:M:S``, ``M:S`` or ``S`` (with a fraction) in milliseconds; null if a part is no number."""
    parts = F.reverse(F.split(text, ":"))
    value = lambda i: F.coalesce(F.get(parts, F.lit(i)).try_cast("double"), F.when(F.size(parts) <= i, F.lit(0.0)))
    return F.round((value(0) + 60 * value(1) + 3600 * value(2)) * 1000).cast("long")


def hours_of_ms(ms: Column) -> Column:
    return ms / 1000.0 / 60.0 / 60.0


def pcm_seconds(audio: Column, rate: int = 16000, width: int = 2) -> Column:
    return F.octet_length(audio) / F.lit(float(rate * width))


def centre_weight(i: Column, n: Column, direction: int = 0) -> Column:
    """Quadratic weight of place i of n: 1 at the ends and 0 in the middle (0), falling (-1) or rising (1)."""
    d = (direction > 0) - (direction < 0)
    last = n - 1
    c = (i + last * F.lit((d - 1) / 2.0)) / last
    return F.when(n == 1, F.lit(1.0)).otherwise(c * c * (4 - abs(d) * 3))


def as_map(json: Column) -> Column:
    return F.from_json(json, "map<string,string>")


def with_key(json: Column, key: str, value: Column) -> Column:
    """A JSON object of strings with ``key`` set."""
    return F.to_json(F.map_concat(F.map_filter(F.coalesce(as_map(json), F.create_map().cast("map<string,string>")), lambda k, _: k != key), F.create_map(F.lit(key), value.cast("string"))))


def merged_unique(lists: Column) -> Column:
    """Values of an array of arrays, each once, in order of appearance."""
    return F.array_distinct(F.flatten(lists))


def _field(name: str):
    return lambda x: x[name]


def unzipped(rows: Column, *fields: str) -> Column:
    """An array of structs as a struct of arrays."""
    return F.struct(*[F.transform(rows, _field(f)).alias(f) for f in fields])


def zipped(arrays: Column, *fields: str) -> Column:
    """A struct of arrays as an array of structs."""
    return F.arrays_zip(*[arrays[f].alias(f) for f in fields])


# Frequent words that tell languages apart.
STOP_WORDS = {
    "de": "der die das und ist nicht ein eine mit von zu den dem des im auf für sich auch werden".split(),
    "en": "the of and to in is that for it was with as on be at by this from are or".split(),
    "es": "el la de que y en los del las por con no una su para es al lo como más".split(),
    "fr": "le la les de des et est que qui dans en un une du pour pas sur au avec par".split(),
}


def guessed_language(w: Column, least: int = 1) -> Column:
    """The language most of whose frequent words occur in ``w``, the first by code on ties; empty if fewer than ``least`` do."""
    own = [F.struct((-F.size(F.array_intersect(w, F.array(*map(F.lit, words_))))).alias("n"), F.lit(code).alias("code")) for code, words_ in sorted(STOP_WORDS.items())]
    best = F.array_min(F.array(*own))
    return F.when(-best["n"] >= least, best["code"]).otherwise(F.lit(""))


def merged_targets(a: Column, b: Column, sure: float = 0.5) -> Column:
    """The mean of two arrays of class shares where both are above ``sure`` for the same class, else zeros."""
    top = lambda x: F.array_position(x, F.array_max(x))
    agree = (F.array_max(a) > sure) & (F.array_max(b) > sure) & (top(a) == top(b))
    return F.zip_with(a, b, lambda x, y: F.when(agree, (x + y) / 2).otherwise(F.lit(0.0)))


def longest_first(items: Column) -> Column:
    """Texts by falling length, as they came where lengths are equal."""
    ranked = F.array_sort(F.transform(items, lambda x, i: F.struct((-F.length(x)).alias("n"), i.alias("i"), x.alias("x"))))
    return F.transform(ranked, lambda r: r["x"])


def outwards(items: Column, centre: Column | None = None) -> Column:
    """Items from the middle (or a given place from 0) outwards, the later of two first."""
    c = F.floor(F.size(items) / 2) if centre is None else centre
    c = F.greatest(F.lit(0), F.least(c, F.size(items) - 1))
    ranked = F.array_sort(F.transform(items, lambda x, i: F.struct(F.abs(i - c).alias("d"), (-i).alias("i"), x.alias("x"))))
    return F.transform(ranked, lambda r: r["x"])
