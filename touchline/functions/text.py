"""Column -> Column normalisers and parsers.

Each function returns a built-in Catalyst expression (no Python UDF), so the
logic runs inside whole-stage codegen on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions.util import col, lit_str

# --- fixed values (must equal the captured site's conventions) -------------
# Dash variants found in captured score cells, all meaning "-":
#   en dash U+2013, em dash U+2014, and the en dash's UTF-8 bytes read as Mac Roman.
SCORE_DASHES = ["\u2013", "\u2014", "\u201a\u00c4\u00ec"]
# URL path markers that precede a match id / player id.
MATCH_URL_MARKER = "/en/matches/"
PLAYER_URL_MARKER = "/en/players/"
# Notes that mean no player statistics exist for the match (case-insensitive).
NOTES_SKIP_PHRASES = ["Match Cancelled", "Match Canceled", "Match awarded"]
# Notes that classify a score-less match as cancelled (case-insensitive substrings).
CANCEL_PHRASES = ["match cancelled", "match canceled"]
# Surrogate-key convention: md5 over the '-'-joined text of the key columns,
# with this placeholder standing in for NULL.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
# Shoot-out score shape "(h) a-b (p)", searched anywhere in the text.
SHOOTOUT_PATTERN = r"\((\d+)\)\s*(\d+)-(\d+)\s*\((\d+)\)"
# Three non-breaking spaces before a substitute's name, as written and as shown.
SUB_INDICATORS = ["&nbsp;&nbsp;&nbsp;", "\u00a0\u00a0\u00a0"]
# Characters made file-safe in storage keys.
SEASON_KEY_REPLACE = {"/": "_", " ": "_"}
DATE_KEY_REPLACE = {"/": "-", " ": "_", ":": "-"}
# ---------------------------------------------------------------------------

# Characters Python's ``str.strip()`` removes: every code point with
# ``isspace()``, derived by rule (29 characters, none above U+3000).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once instead of at every mention."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_code(c) -> Column:
    """``c`` itself, for one column of a wide ``select``. Spark writes such a select
    with the steps around it as one method, and the JVM leaves a method of more
    than 8,000 bytes uncompiled, several times slower. With a lambda, the select
    gets code of its own, in many small methods."""
    return let(col(c), lambda value: value)


def strip(c) -> Column:
    """Remove leading/trailing whitespace incl. non-breaking spaces (like ``str.strip``).

    A plain character-set trim: no regex, one pass over the string.
    """
    return F.btrim(col(c), F.lit(WHITESPACE))


def blank_to_null(c) -> Column:
    """Empty text -> NULL."""
    return F.nullif(col(c), F.lit(""))


def clean_text(c) -> Column:
    """Strip, then empty -> NULL."""
    return blank_to_null(strip(c))


def null_tokens(c, tokens=("", "nan", "None", "<NA>")) -> Column:
    """Text placeholders for a missing value (``''``, ``nan``, ``None``, ``<NA>``) -> NULL."""
    c = col(c).cast("string")
    return F.when(~c.isin(*tokens), c)


# N1
def normalize_score(c) -> Column:
    """Unify dash variants to ``-``, strip, empty -> NULL."""
    out = col(c)
    for d in SCORE_DASHES:
        out = F.replace(out, F.lit(d), F.lit("-"))
    return clean_text(out)


def after_marker(c, marker: str) -> Column:
    """Text after the first occurrence of ``marker`` ('' when absent)."""
    c = col(c)
    pos = F.instr(c, marker)
    return F.when(pos > 0, F.substr(c, pos + F.lit(len(marker)))).otherwise(F.lit(""))


# N2 / N3
def url_token(c, marker: str) -> Column:
    """First path token after ``marker``; NULL if the marker is absent or the token is empty."""
    c = col(c)
    token = F.split_part(after_marker(c, marker), F.lit("/"), F.lit(1))
    return F.when(c.contains(marker), blank_to_null(token))


def match_id_from_url(c) -> Column:
    return url_token(c, MATCH_URL_MARKER)


def player_id_from_url(c) -> Column:
    return url_token(c, PLAYER_URL_MARKER)


# N4
def name_from_slug(c, marker: str = PLAYER_URL_MARKER) -> Column:
    """Second token after the marker with ``-`` as space; NULL if absent or blank."""
    c = col(c)
    slug = F.split_part(after_marker(c, marker), F.lit("/"), F.lit(2))
    return F.when(c.contains(marker), clean_text(F.translate(slug, "-", " ")))


# N5
def nationality_code(c) -> Column:
    """Last whitespace token that is upper case and >= 2 long, else the last token."""
    s = strip(c)
    parts = F.split(s, "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in WHITESPACE) + "]+")
    codes = F.filter(parts, lambda p: (F.length(p) >= 2) & (F.upper(p) == p) & (F.lower(p) != p))
    last = F.try_element_at(parts, F.lit(-1))
    return F.when(s != "", F.coalesce(F.try_element_at(codes, F.lit(-1)), last))


# N6
def primary_position(c) -> Column:
    """Text before the first comma (stripped); the value itself when there is no comma."""
    c = col(c)
    return F.when(c.contains(","), strip(F.split_part(c, F.lit(","), F.lit(1)))).otherwise(c)


# N7
def naive_score_split(c) -> tuple[Column, Column]:
    """Split on the first ``-``: (home text, away text); NULL when no dash."""
    c = col(c)
    pos = F.instr(c, "-")
    has = pos > 0
    return (
        F.when(has, clean_text(F.substr(c, F.lit(1), pos - 1))),
        F.when(has, clean_text(F.substr(c, pos + 1))),
    )


# N8
def notes_skip(c) -> Column:
    """True when notes mention a cancelled/awarded match; NULL notes -> False."""
    low = F.lower(strip(c))
    cond = None
    for p in NOTES_SKIP_PHRASES:
        t = low.contains(p.lower())
        cond = t if cond is None else (cond | t)
    return F.coalesce(cond, F.lit(False))


# N9
# A date is read by its tokens, not by layouts: numbers by their width, month
# names, separators; clocks, zones, weekdays, ordinal endings and fillers go.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
DATE_FILLERS = ["of", "on", "at", "and", "ad", "t"]
CLOCK = (r"(?:(?<=[0-9])t|\bt|\bat|\s|^)\s*[0-9]{1,2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?(?:\s*[ap]\.?m\b\.?)?|\s*[ap]\.?m\b\.?)"
         r"(?:\s*(?:z|utc|gmt)\b|\s*[+-][0-9]{2}:?[0-9]{2}\b)*|(?<=[0-9]{8})t[0-9]{4,6}z?$")
WEEKDAY = r"\b(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?\b"
ORDINAL = r"([0-9])(?:st|nd|rd|th)\b"
TOKEN = r"[0-9]+|[a-z]+|[^0-9a-z\s]"


def _date_tokens(s: Column) -> Column:
    """Numbers, months (as ``m`` and their number), and whatever else is no filler."""
    low = F.regexp_replace(F.lower(s), CLOCK, " ")
    low = F.regexp_replace(F.regexp_replace(low, ORDINAL, "$1"), WEEKDAY, " ")
    names = [(name[:k], i + 1) for i, name in enumerate(MONTHS) for k in {3, len(name)}] + [("sept", 9)]
    number = F.create_map(*[F.lit(x) for name, i in names for x in (name, f"m{i}")])
    tokens = F.transform(F.regexp_extract_all(low, F.lit(TOKEN), F.lit(0)), lambda w: F.coalesce(F.element_at(number, w), w))
    return F.filter(tokens, lambda w: ~w.isin(*DATE_FILLERS, ".", ",", ";", "-", "/", "'"))


def _resolved_date(tokens: Column) -> Column:
    """The date of up to three tokens, by what each can be: a month by its name;
    a year by four digits or a value above 31; of two other numbers the month
    first, unless it is above 12; a day that is not there is the first."""
    def part(i: int) -> Column:
        w = F.get(tokens, F.lit(i))
        month = w.startswith("m")
        n = F.when(month, F.substr(w, F.lit(2))).otherwise(w).try_cast("int")
        return F.struct(n.alias("n"), F.coalesce(month, F.lit(False)).alias("month"), (~month & ((F.length(w) > 2) | (n > 31))).alias("year"), w.alias("w"))

    now = F.year(F.current_date())
    near = lambda y: y["n"] + F.when(y["year"] & (F.length(y["w"]) > 2), 0).otherwise(  # noqa: E731  of two digits, the year within fifty of this one
        F.floor(now / 100) * 100 + F.when(y["n"] + F.floor(now / 100) * 100 >= now + 50, -100).when(y["n"] + F.floor(now / 100) * 100 < now - 50, 100).otherwise(0))
    text = lambda y, m, d: F.when((m < 13) & (d < 32), F.format_string("%04d-%02d-%02d", y.cast("int"), m, d))
    one = F.lit(1)

    def swapped(y: Column, a: Column, b: Column) -> Column:
        """Month and day in this order, unless the first can be no month."""
        other = (a["n"] > 12) & (b["n"] <= 12)
        return text(near(y), F.when(other, b["n"]).otherwise(a["n"]), F.when(other, a["n"]).otherwise(b["n"]))

    def resolve(p: Column) -> Column:
        a, b, c, size = p["a"], p["b"], p["c"], p["size"]
        w = a["w"]
        digits = lambda at, n: F.substr(w, F.lit(at), F.lit(n)).try_cast("int")
        short = [F.struct(digits(k, 2).alias("n"), F.lit(False).alias("year"), w.alias("w")) for k in (1, 3, 5)]  # six digits are three numbers
        six = F.when(short[0]["n"] > 31, swapped(*short)).otherwise(swapped(short[2], *short[:2]))
        single = F.when(F.length(w) == 8, text(digits(1, 4), digits(5, 2), digits(7, 2))).when(F.length(w) == 6, six).when(F.length(w) == 4, text(a["n"], one, one))
        pair = F.when(a["month"] & b["year"], text(near(b), a["n"], one)).when(b["month"] & a["year"], text(near(a), b["n"], one)).when(
            ~a["month"] & ~b["month"] & (F.length(a["w"]) == 4), text(a["n"], b["n"], one)).when(~a["month"] & ~b["month"] & (F.length(b["w"]) == 4), text(b["n"], a["n"], one))
        named = F.when(a["month"], F.when(b["year"], text(near(b), a["n"], c["n"])).otherwise(text(near(c), a["n"], b["n"]))).when(
            b["month"], F.when(a["year"], text(near(a), b["n"], c["n"])).otherwise(text(near(c), b["n"], a["n"]))).otherwise(
            F.when(b["year"], text(near(b), c["n"], a["n"])).otherwise(text(near(a), c["n"], b["n"])))
        months = a["month"].cast("int") + b["month"].cast("int") + c["month"].cast("int")
        plain = F.when(a["year"], swapped(a, b, c)).when(~b["year"], swapped(c, a, b))
        return F.when(size == 1, F.when(~a["month"], single)).when(size == 2, pair).when(size == 3, F.when(months == 1, named).when(months == 0, plain))

    parts = F.struct(part(0).alias("a"), part(1).alias("b"), part(2).alias("c"), F.size(tokens).alias("size"))
    known = F.forall(tokens, lambda w: w.rlike("^m?[0-9]{1,8}$"))
    return F.when(known & (F.size(tokens) <= 3), let(parts, resolve).try_cast("date"))


def try_parse_date(c) -> Column:
    """Tolerant date parse by tokens; what is no date gives NULL. A date in ISO
    form alone, as nearly all are, is cast at once."""
    s = strip(c)
    return F.when(s.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), s.try_cast("date")).otherwise(let(_date_tokens(s), _resolved_date))


# N10
def numeric_or_zero(c) -> Column:
    """Non-numeric -> NULL -> 0.0."""
    return F.coalesce(col(c).cast("string").try_cast("double"), F.lit(0.0))


# N11
def file_safe(c, mapping: dict[str, str]) -> Column:
    src = "".join(mapping)
    dst = "".join(mapping[k] for k in mapping)
    return F.translate(col(c).cast("string"), src, dst)


def season_file_key(c) -> Column:
    return file_safe(c, SEASON_KEY_REPLACE)


def date_file_key(c) -> Column:
    return file_safe(c, DATE_KEY_REPLACE)


# N12
def season_key_from_filename(path) -> tuple[Column, Column]:
    """(league_id, year) as longs from ``match_level_data_<L>_<Y>.csv``; (0, 0) otherwise."""
    base = F.regexp_extract(col(path), r"([^/]*)$", 1)
    pat = r"(?i)^match_level_data_(\d+)_(\d+)\.csv"
    ok = base.rlike(pat)
    league = F.when(ok, F.regexp_extract(base, pat, 1).cast("long")).otherwise(F.lit(0).cast("long"))
    year = F.when(ok, F.regexp_extract(base, pat, 2).cast("long")).otherwise(F.lit(0).cast("long"))
    return league, year


def season_id_from_filename(path) -> Column:
    base = F.regexp_extract(col(path), r"([^/]*)$", 1)
    return F.replace(F.replace(base, lit_str("match_level_data_"), lit_str("")), lit_str(".csv"), lit_str(""))


def date_from_player_filename(path, season_id) -> Column:
    """``player_match_data_<season>_<date>.csv`` -> ``<date>`` (NULL when the prefix differs)."""
    base = F.substring_index(col(path), "/", -1)
    prefix = F.concat(lit_str("player_match_data_"), season_file_key(season_id), lit_str("_"))
    ok = base.startswith(prefix) & base.endswith(".csv")
    inner = F.substr(base, F.length(prefix) + 1, F.length(base) - F.length(prefix) - 4)
    return F.when(ok, blank_to_null(inner))


# D1
def trim_score(c) -> Column:
    """Strip spaces and apostrophes from both ends (spreadsheet-safe prefix removal)."""
    return F.btrim(col(c), F.lit(" '"))


# D2
def is_shootout(c) -> Column:
    """Does the text contain a shoot-out score ``(h) a-b (p)``? (NULL -> false)."""
    return F.coalesce(col(c).rlike(SHOOTOUT_PATTERN), F.lit(False))


def parse_score(c, shootout_flag=None) -> dict[str, Column]:
    """Score text -> home/away goals and shoot-out goals (ints).

    A shoot-out score ``(4) 1-1 (2)`` anywhere in the text fills all four
    numbers; otherwise the parts around the first/second ``-`` are cast
    strictly (bad text raises, like a strict cast).
    """
    s = col(c)
    is_so = is_shootout(s) if shootout_flag is None else col(shootout_flag)

    def grp(i):
        return F.regexp_extract(s, SHOOTOUT_PATTERN, i).cast("int")

    plain_home = F.trim(F.split_part(s, F.lit("-"), F.lit(1))).cast("int")
    plain_away = F.trim(F.split_part(s, F.lit("-"), F.lit(2))).cast("int")
    return {
        "home_penalty_shootout_goals": F.when(is_so, grp(1)),
        "home_team_score": F.when(is_so, grp(2)).otherwise(plain_home),
        "away_team_score": F.when(is_so, grp(3)).otherwise(plain_away),
        "away_penalty_shootout_goals": F.when(is_so, grp(4)),
    }


# P6
def age_numeric(c) -> Column:
    """``'YY-DDD'`` -> YY + DDD/365 (double); an unparsable part -> NULL."""
    c = col(c)
    yy = F.split_part(c, F.lit("-"), F.lit(1)).try_cast("int")
    dd = F.split_part(c, F.lit("-"), F.lit(2)).try_cast("int")
    return yy + dd / F.lit(365)


# T2
def surrogate_key(*cols) -> Column:
    """md5 of the '-'-joined text of ``cols`` with a NULL placeholder."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL)))
    return F.md5(F.concat(*parts))


# S12
def spreadsheet_safe(c) -> Column:
    """NULL / ``nan`` -> ``''``; non-empty text gets a leading apostrophe."""
    c = col(c).cast("string")
    v = F.coalesce(F.when(c != "nan", c), F.lit(""))
    return F.when(v != "", F.concat(F.lit("'"), v)).otherwise(F.lit(""))


# X12

def lineup_status(cell_html) -> Column:
    """``Sub`` when the player cell carries three non-breaking spaces, else ``Starter``."""
    c = col(cell_html)
    cond = None
    for s in SUB_INDICATORS:
        t = F.coalesce(c.contains(s), F.lit(False))
        cond = t if cond is None else (cond | t)
    return F.when(cond, F.lit("Sub")).otherwise(F.lit("Starter"))
