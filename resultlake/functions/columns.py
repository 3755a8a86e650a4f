"""Functions from columns to columns: text, dates, numbers, arrays and JSON.

What elsewhere needs a function for each element (F01: leads X02, names X11, deals X15,
classes X20) is such a column here too. All are built-in Spark expressions, so they stay in generated code; text that does not
parse gives null, never an error, although ANSI mode is on.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Col = Column | str


def _c(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract(c: Col, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without a match (``regexp_extract`` gives '')."""
    c = _c(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` names it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


# ---- contracts and results -------------------------------------------------

CONTRACT = r"^([1-7])([CDHSN])(X{0,2})$"


def _plain_contract(contract: Col) -> Column:
    """Upper case, without blanks, NT as N."""
    return F.replace(F.upper(F.regexp_replace(_c(contract), r"\s+", "")), F.lit("NT"), F.lit("N"))


def contract_parts(contract: Col) -> Column:
    """(plain, level, strain, doubled) of a contract, which is made plain and matched once.

    Level is 0, strain and doubling null where there is no contract, as for a passed board.
    """
    plain = _plain_contract(contract)
    good = plain.rlike(CONTRACT)  # so its places are known: level, strain, doubling
    whole = F.struct(plain.alias("plain"), F.substring(plain, 1, 1).cast("int").alias("level"), F.substring(plain, 2, 1).alias("strain"), F.substring(plain, 3, 2).alias("doubled"))
    none = F.struct(plain.alias("plain"), F.lit(0).alias("level"), F.lit(None).cast("string").alias("strain"), F.lit(None).cast("string").alias("doubled"))
    return F.when(good, whole).otherwise(none)


def contract_level(contract: Col) -> Column:
    """1 to 7; 0 where there is no level, as for a passed board or null."""
    return F.coalesce(contract_parts(contract)["level"], F.lit(0))


def contract_strain(contract: Col) -> Column:
    return contract_parts(contract)["strain"]


def contract_doubled(contract: Col) -> Column:
    """'', 'X' or 'XX'; null for a passed board."""
    return contract_parts(contract)["doubled"]


def contract_text(parts: Col, declarer: Col) -> Column:
    """The text of :func:`normalize_contract` from the parts."""
    p = _c(parts)
    rebuilt = F.concat(p["level"].cast("string"), p["strain"], p["doubled"], F.upper(F.trim(_c(declarer))))
    return F.when(p["plain"] == "PASS", "PASS").otherwise(rebuilt)


def normalize_contract(contract: Col, declarer: Col) -> Column:
    """Level, strain, doubling and declarer as one text; PASS stays; what is neither is null."""
    return let(contract_parts(contract), lambda p: contract_text(p, declarer))


def clean_lead(c: Col) -> Column:
    """A led card as suit and rank; 10 is T, either order is read, anything else is null."""
    card = F.replace(F.upper(F.regexp_replace(_c(c), r"\s+", "")), F.lit("10"), F.lit("T"))
    swapped = lambda t: F.concat(F.substring(t, 2, 1), F.substring(t, 1, 1))
    return let(card, lambda t: F.when(t.rlike("^[CDHS][2-9TJQKA]$"), t).when(t.rlike("^[2-9TJQKA][CDHS]$"), swapped(t)))


def typed_result(result: Col, tricks: Col) -> tuple[Column, Column]:
    """(result, tricks) as numbers; both null where either is impossible.

    '=' is 0, a sign may precede the result; a result is -13 to 6, tricks are 0 to 13.
    """
    res, tri = F.trim(_c(result)), F.trim(_c(tricks).cast("string"))
    r = F.when(res == "=", 0).otherwise(F.when(res.rlike(r"^[+-]?\d+$"), res.try_cast("int")))
    t = F.when(tri.rlike(r"^\d+$"), tri.try_cast("int"))
    wrong = F.coalesce(~r.between(-13, 6), F.lit(False)) | F.coalesce(~t.between(0, 13), F.lit(False))
    return F.when(~wrong, r), F.when(~wrong, t)


def total_tricks(level: Col, result: Col, tricks: Col) -> tuple[Column, Column]:
    """(result, tricks): tricks that were counted over book get 6 more where only that fits the result.

    Where neither reading fits both are null; without a result the tricks stay.
    """
    lv, r, t = _c(level), _c(result), _c(tricks)
    expected = lv + 6 + r
    fits, over = t == expected, t + 6 == expected
    passed = (lv == 0) | r.isNull() | t.isNull()
    return F.when(passed | fits | over, r), F.when(passed | fits, t).when(over, t + 6)


def level_strain(contract: Col) -> Column:
    """The first two characters: the class of a contract."""
    return F.substring(_c(contract), 1, 2)


# ---- text ------------------------------------------------------------------


def zfill(c: Col, n: int) -> Column:
    """Zeros on the left up to ``n`` characters; longer text is kept whole."""
    c = _c(c)
    return F.when(F.length(c) < n, F.lpad(c, n, "0")).otherwise(c)


def strip_suffix(c: Col, pattern: str = r"\s*\(swap names\)\s*$") -> Column:
    """Without a trailing marker."""
    return F.regexp_replace(_c(c), pattern, "")


def id_prefix(c: Col, sep: str = "-", k: int = 1) -> Column:
    """The first ``k`` parts of a delimited id."""
    return F.substring_index(_c(c), sep, k)


def id_list(c: Col) -> Column:
    """The ``#?digits`` tokens of a list in text; a token of zeros is null but keeps its place."""
    found = F.regexp_extract_all(_c(c), F.lit(r"(#?\d+)"), 1)
    return F.transform(found, lambda t: F.when(~t.rlike(r"^#?0+$"), t))


def block_key(c: Col, pattern: str = r"^(\d{4}|[A-Z]+\d{2})") -> Column:
    """What the pattern matches at the start, else the first four characters."""
    c = _c(c)
    return F.coalesce(F.regexp_substr(c, F.lit(pattern)), F.substring(c, 1, 4))


def pair_key(a: Col, b: Col) -> Column:
    """``least-greatest`` of two ids as text; null if one is missing or both are equal."""
    a, b = _c(a).cast("string"), _c(b).cast("string")
    return F.when(a.isNotNull() & b.isNotNull() & (a != b), F.concat_ws("-", F.least(a, b), F.greatest(a, b)))


def given_first(c: Col) -> Column:
    """``Last, First`` as ``First Last`` (X11)."""
    return F.trim(F.regexp_replace(_c(c), r"^\s*([^,]*?)\s*,\s*(.*?)\s*$", "$2 $1"))


@cache
def _folded() -> tuple[str, str, list[tuple[str, str]]]:
    """(characters, what each becomes, [(character, several)]) by compatibility decomposition without marks.

    Of the first 65,536 code points; marks become nothing. Characters that become several
    are those of the Latin blocks and ligatures.
    """
    one, to, gone, many = [], [], [], []
    for i in (*range(0x80, 0xD800), *range(0xF900, 0x10000)):
        c = chr(i)
        text = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).casefold()
        if unicodedata.combining(c):
            gone.append(c)
        elif re.fullmatch("[a-z0-9]", text):
            one.append(c)
            to.append(text)
        elif re.search("[a-z0-9]", text) and (i < 0x250 or 0x1E00 <= i < 0x1F00 or 0xFB00 <= i < 0xFB07):
            many.append((c, text))
    return "".join(one + gone), "".join(to), many


def fold_text(c: Col) -> Column:
    """Lower case without accents, other characters as single blanks.

    Letters are decomposed as in NFKD by a table, so it stays a column expression.
    """
    chars, plain, many = _folded()
    low = reduce(lambda a, m: F.replace(a, F.lit(m[0]), F.lit(m[1])), many, F.translate(_c(c), chars, plain))
    return F.trim(F.regexp_replace(F.lower(low), "[^a-z0-9]+", " "))


def name_list(c: Col) -> Column:
    """A list of names in text, without brackets and quotes."""
    inner = F.regexp_replace(_c(c), r"""^\s*\[|\]\s*$|["']""", "")
    return F.when(F.trim(inner) == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(inner, ","), lambda x: F.trim(x)))


# ---- par -------------------------------------------------------------------

PAR = r"^([1-7])(NT|N|S|H|D|C)(\*{0,2})-(NS|EW|N|S|E|W)([+-]\d+)?$"


def parse_par(c: Col) -> Column:
    """``Par: +140 3H-NS/3S-NS`` as (score, contracts); malformed text is null."""
    body = extract(c, r"^Par:\s*(\S.*?)\s*$")
    score = extract(body, r"^([+-]?\d+)(\s|$)").try_cast("int")
    rest = F.trim(F.regexp_replace(body, r"^[+-]?\d+\s*", ""))
    parts = F.split(rest, "/")
    valid = F.forall(parts, lambda p: p.rlike(PAR))
    item = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, PAR, 1).alias("Level"), F.substring(F.regexp_extract(p, PAR, 2), 1, 1).alias("Strain"), F.regexp_extract(p, PAR, 3).alias("Doubled"), F.regexp_extract(p, PAR, 4).alias("Pair_Direction"), F.coalesce(F.regexp_extract(p, PAR, 5).try_cast("smallint"), F.lit(0).cast("smallint")).alias("Result")))
    none = F.array(F.struct(F.lit("").alias("Level"), F.lit("").alias("Strain"), F.lit("").alias("Doubled"), F.lit("").alias("Pair_Direction"), F.lit(0).cast("smallint").alias("Result")))
    return F.when((score == 0) & (rest == ""), F.struct(score.alias("score"), none.alias("contracts"))).when(score.isNotNull() & valid, F.struct(score.alias("score"), item.alias("contracts")))


def par_side(c: Col, sign: int) -> Column:
    """Distinct strains of the par contracts of one side: NS for 1, EW for -1; each contract counts for who holds it."""
    names = ("NS", "N", "S") if sign > 0 else ("EW", "E", "W")
    own = F.filter(_c(c), lambda p: p["Pair_Direction"].isin(*names))
    return F.array_distinct(F.array_compact(F.transform(own, lambda p: F.when(p["Strain"] != "", p["Strain"]))))


def n_distinct_field(c: Col, field: str) -> Column:
    """Distinct values of a field over an array of structs; null has none."""
    return F.coalesce(F.size(F.array_distinct(F.array_compact(F.transform(_c(c), lambda p: p[field])))), F.lit(0))


# ---- deals -----------------------------------------------------------------

RANKS = "AKQJT98765432"
SUITS = "SHDC"


#: The 68 symbols of a deal in order: each rank and each suit four times.
_SYMBOLS = "".join(sorted((SUITS + RANKS) * 4))


def valid_deal(c: Col) -> Column:
    """A deal of 68 symbols: each rank and suit letter four times, four suit letters in the first 17."""
    symbols = lambda t: F.array_join(F.array_sort(F.split(t, "")), "")
    first = lambda t: F.length(F.translate(F.substring(t, 1, 17), SUITS, ""))
    return F.coalesce(let(_c(c), lambda t: (F.length(t) == 68) & (symbols(t) == _SYMBOLS) & (first(t) == 13)), F.lit(False))


_HAND = "S([2-9TJQKA]*)H([2-9TJQKA]*)D([2-9TJQKA]*)C([2-9TJQKA]*)"
#: Letters in the order of ranks, so that sorted letters are sorted cards.
_LETTERS = "ABCDEFGHIJKLM"


def _in_order(cards: Column) -> Column:
    """Cards as letters, the ace first."""
    return F.array_join(F.array_sort(F.split(F.translate(cards, RANKS, _LETTERS), "")), "")


def canonical_deal(c: Col, seats: str = "NESW") -> Column:
    """Hands in the order N, E, S, W with ranks from the ace down, ``S.H.D.C`` each; null unless it is a whole deal.

    The text is matched and split once, and each suit of a hand is sorted once.
    """
    places = [seats.index(s) for s in "NESW"]

    def deal(t: Column) -> Column:
        return let(F.transform(F.slice(F.split(t, "[SHDC]"), 2, 16), _in_order), hands)  # the cards of each suit, hand after hand

    def hands(suits: Column) -> Column:
        each = F.array(*[F.array_join(F.slice(suits, 4 * i + 1, 4), ".") for i in places])
        once = F.forall(F.sequence(F.lit(1), F.lit(4)), lambda j: _sorted_letters(F.concat(*[F.get(suits, j + (4 * i - 1)) for i in range(4)])) == _LETTERS)
        return F.when(once, let(each, lambda h: F.when(F.forall(h, lambda x: F.length(x) == 16), F.concat(F.lit("N:"), F.translate(F.array_join(h, " "), _LETTERS, RANKS)))))

    return let(_c(c), lambda t: F.when(t.rlike(f"^{_HAND * 4}$"), deal(t)))


def _sorted_letters(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(c, "")), "")


def build_deal(columns: dict[str, Col], seats: str = "NESW") -> Column:
    """A deal text from 16 suit columns named ``seat + suit``; 10 is T and dashes are voids."""
    part = lambda k: F.regexp_replace(F.replace(F.upper(F.coalesce(_c(columns[k]), F.lit(""))), F.lit("10"), F.lit("T")), "[^2-9TJQKA]", "")
    return F.concat(*[F.concat(F.lit(suit), part(seat + suit)) for seat in seats for suit in SUITS])


def valid_dd(c: Col, side: str) -> Column:
    """A text of solved tricks: the side's name, then five tokens, one for each strain."""
    body = F.trim(F.regexp_replace(_c(c), rf"^\s*{side}:\s*", ""))
    strain = lambda t: F.substring(F.regexp_extract(t, r"(NT|[SHDCN])", 1), 1, 1)
    token = r"(\d{1,2}(/\d{1,2})?)?(NT|[SHDCN])\d{0,2}(/\d{1,2})?"
    each = lambda t: F.array_join(F.array_sort(F.transform(F.split(t, r"\s+"), strain)), "") == "".join(sorted("SHDCN"))
    return F.coalesce(let(body, lambda t: t.rlike(rf"^{token}(\s+{token}){{4}}$") & each(t)), F.lit(False))


def board_vul(n: Col) -> Column:
    """0 none, 1 NS, 2 EW, 3 both, by board number."""
    z = _c(n).cast("int") - 1
    return (F.floor(z / 4).cast("int") + z.bitwiseAND(F.lit(3))).bitwiseAND(F.lit(3))


# ---- limits ----------------------------------------------------------------

#: Upper ends of masterpoint buckets.
BUCKETS = (300, 500, 750, 1000, 1500, 2500, 5000)


def top_limit(c: Col) -> Column:
    """The largest number of a limit text such as ``0-299``, ``<500`` or ``NLM 1k``; null for open events."""
    text = F.regexp_replace(F.lower(_c(c)), r",", "")
    found = F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?k?)"), 1)
    numbers = F.transform(found, lambda t: F.when(F.endswith(t, F.lit("k")), F.rtrim(t, F.lit("k")).try_cast("double") * 1000).otherwise(t.try_cast("double")))
    return F.when(F.size(found) > 0, F.array_max(numbers).cast("int"))


def limit_bucket(c: Col, grammar: str = "club") -> Column:
    """``open`` or ``0-299`` and so on, by the top limit.

    In the grammar ``tournament`` several limits separated by a slash are strata: the
    highest counts, and a stratum without a number makes the event open.
    """
    top = top_limit(c)
    if grammar == "tournament":
        parts = F.split(_c(c), "/")
        top = F.when(F.forall(parts, lambda p: p.rlike(r"\d")), top)
    out = F.when(top.isNull() | (top <= 0) | (top > BUCKETS[-1]), "open")
    for b in BUCKETS:
        out = out.when(top <= b, f"0-{b - 1}")
    return out


# ---- dates -----------------------------------------------------------------

#: Date formats, the first that parses wins.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy")


def parse_date_any(c: Col) -> Column:
    """A date in one of several formats, else null."""
    parse = lambda t, formats: F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats])
    # a text is tried against the formats of its shape only: with a slash, with a month's name, or by its length
    slashed, named, dated = [[f for f in DATE_FORMATS if f[0] == "M" and ("/" in f) == b] for b in (True, False)] + [[f for f in DATE_FORMATS if f[0] == "y"]]
    short, long = [f for f in dated if "H" not in f], [f for f in dated if "H" in f]
    shape = lambda t: F.when(t.rlike("^[A-Za-z]"), parse(t, named)).when(F.contains(t, F.lit("/")), parse(t, slashed)).when(F.contains(t, F.lit(":")), parse(t, long)).otherwise(parse(t, short))
    return let(F.trim(_c(c)), shape).cast("date")


def parse_ts(c: Col, fmt: str = "yyyy-MM-dd HH:mm:ss", strict: bool = False) -> Column:
    """A timestamp; text that does not parse is an error if ``strict``, else null."""
    return F.to_timestamp(_c(c), fmt) if strict else F.try_to_timestamp(_c(c), F.lit(fmt))


def window_of(c: Col, unit: str = "month", n: int = 1) -> tuple[Column, Column]:
    """[start, end) of the window of ``n`` months or years that a date lies in."""
    months = n * (12 if unit == "year" else 1)
    c = _c(c).cast("date")
    index = F.floor((F.year(c) * 12 + F.month(c) - 1) / F.lit(months)).cast("int") * months
    start = F.make_date(F.floor(index / 12).cast("int"), (index % 12 + 1).cast("int"), F.lit(1))
    return start, F.add_months(start, months)


def in_range_or_unknown(c: Col, lo: str | None, hi: str | None) -> Column:
    """Within inclusive dates; dates that are null or do not parse are kept."""
    d = parse_date_any(_c(c).cast("string"))
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (d >= F.lit(lo).cast("date"))
    if hi is not None:
        ok = ok & (d <= F.lit(hi).cast("date"))
    return d.isNull() | ok


# ---- numbers ---------------------------------------------------------------

#: Ranges of unsigned types, which are read as the next wider signed type.
UNSIGNED = {"uint8": ("smallint", 255), "uint16": ("int", 65535), "uint32": ("bigint", 4294967295)}


def tolerant_cast(c: Col, kind: str) -> Column:
    """A cast that gives null instead of failing; unsigned kinds are range-checked."""
    if kind in UNSIGNED:
        wide, most = UNSIGNED[kind]
        v = _c(c).try_cast(wide)
        return F.when(v.between(0, most), v)
    return _c(c).try_cast(kind)


def leading_number(c: Col, kind: str = "int") -> Column:
    """The number that a text begins with, 0 without one; null stays null."""
    c = _c(c)
    pattern = r"^\s*([+-]?\d+)" if kind in ("int", "bigint", "smallint") else r"^\s*([+-]?(?:\d+\.?\d*|\.\d+))"
    return F.when(c.isNotNull(), F.coalesce(F.regexp_extract(c, pattern, 1).try_cast(kind), F.lit(0).cast(kind)))


def text_bool(c: Col) -> Column:
    """1, true, t and 0, false, f in any case; null otherwise."""
    low = F.lower(F.trim(_c(c).cast("string")))
    return F.when(low.isin("1", "true", "t"), True).when(low.isin("0", "false", "f"), False)


def coerce_key(c: Col, numeric: bool, keep_nulls: bool = True) -> Column:
    """A key as text of its declared affinity: true is 1, +7 is 7, text that is no number stays.

    An empty numeric key is null, or '' unless ``keep_nulls``.
    """
    text = F.trim(_c(c).cast("string"))
    if not numeric:
        return text if keep_nulls else F.coalesce(text, F.lit(""))
    low = F.lower(text)
    whole = extract(text, r"^\+?(-?\d+)(?:\.0*)?$").try_cast("bigint").cast("string")
    out = F.when(low == "true", "1").when(low == "false", "0").when(text == "", None).otherwise(F.coalesce(whole, text))
    return out if keep_nulls else F.coalesce(out, F.lit(""))


def finite(c: Col) -> Column:
    """NaN and infinities as null."""
    c = _c(c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def scaled(c: Col, center: float = 1500.0, unit: float = 100.0) -> Column:
    """(x - center) / unit."""
    return (_c(c) - center) / unit


def clip(c: Col, lo: float, hi: float) -> Column:
    """Within [lo, hi]; null stays null."""
    c = _c(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def row_mean_std(columns: list[Col]) -> tuple[Column, Column]:
    """Mean and population deviation across columns of a row."""
    cs = [_c(c).cast("double") for c in columns]
    mean = reduce(lambda a, b: a + b, cs) / float(len(cs))
    return mean, F.sqrt(reduce(lambda a, b: a + b, [(c - mean) * (c - mean) for c in cs]) / float(len(cs)))


# ---- arrays and JSON -------------------------------------------------------


def pad2(c: Col) -> Column:
    """An array cut or filled with nulls to two."""
    c = F.coalesce(_c(c), F.array().cast("array<string>"))
    return F.slice(F.concat(c, F.array(F.lit(None).cast("string"), F.lit(None).cast("string"))), 1, 2)


def at(c: Col, i: int) -> Column:
    """The element at an index from 0, null beyond the ends."""
    return F.get(_c(c), i)


def json_scalars(c: Col, fields: dict[str, str]) -> dict[str, Column]:
    """Scalar fields of a JSON object as columns; nested values and other types are null."""
    parsed = F.from_json(_c(c), T.MapType(T.StringType(), T.StringType()))
    return {name: tolerant_cast(F.when(~parsed[name].rlike(r"^[\[{]"), parsed[name]), kind) for name, kind in fields.items()}


def _field(name: str) -> Callable[[Column], Column]:
    return lambda x: x[name]


def doc_has(c: Col, path: list[str], field: str, value: Col) -> Column:
    """Whether a nested member, along arrays of structs, has a value."""
    out = _c(c)
    for name in path:
        out = F.flatten(F.transform(out, _field(name)))
    return F.coalesce(F.exists(out, lambda x: x[field] == _c(value)), F.lit(False))
