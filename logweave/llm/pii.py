"""Format-preserving Feistel pseudonyms for validated numbers and dates.

Texts are cut into pieces; a piece that has the form of a personal number or
date *and* validates (Luhn, calendar, number ranges) is mapped to another of
the same form by a keyed Feistel permutation of its digits, and written back
with its own separators.  Equal values, also with other separators, get equal
pseudonyms in all documents; others stay different, since the mapping is a
permutation of the valid values of the format.

Kinds: payment cards (13 to 19 digits, Luhn; the last digit is recomputed),
phone numbers (ten digits, an optional +1 stays), social security numbers,
IPv4 addresses, dates of 1900 to 2099 (YYYY-MM-DD, YYYY/MM/DD, DD.MM.YYYY,
MM/DD/YYYY), the local part of e-mail addresses, and secrets in ``token =
"..."`` (hexadecimal).  Numbers that fail their validation stay as they are.

Everything is SQL: pieces by ``regexp_extract_all``, the rounds of the network
by ``aggregate`` over an array of cells (value, radix).  Each row is rewritten
where it is read: no shuffle, no Python, memory of one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The session setting that holds the key: whoever knows it can undo the pseudonyms.
SETTING = "spark.logweave.pii.key"
ROUNDS = 8

OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Form of each kind, as a whole piece (Java syntax).
FORMS = {
    "email": "[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:[.][A-Za-z0-9-]{1,63}){1,8}",
    "secret": '(?<=token = ")[0-9a-f]{16,64}(?=")',
    "phone": "(?<![0-9])(?:[+]1[ -]?)?(?:[(][0-9]{3}[)] ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])",
    "ssn": "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iso": "(?<![0-9])[0-9]{4}(?:-[0-9]{2}-|/[0-9]{2}/)[0-9]{2}(?![0-9])",
    "dmy": "(?<![0-9.])[0-9]{2}[.][0-9]{2}[.][0-9]{4}(?![0-9])",
    "mdy": "(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/])",
    "ip": f"(?<![0-9.]){OCTET}(?:[.]{OCTET}){{3}}(?![0-9]|[.][0-9])",
    "card": "(?<![0-9])(?:[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}-[0-9]{6}-[0-9]{5}|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{13,19})(?![0-9])",
}
#: Pieces: a candidate, or a run without the start of one.
PIECE = "(?s)" + "|".join(FORMS.values()) + "|[0-9]+|[A-Za-z]+|[^0-9A-Za-z(+._%-]+|."
#: Texts without these have no candidate at all.
ANY = "[0-9]{2}|@|[0-9][.][0-9]|token = "
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)  # 17 * 4297 days end with 2099
SSN = (898, 99, 9999)  # areas 001 to 899 without 666, groups from 01, serials from 0001


def sql(text: str) -> str:
    """A literal, for a raw SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def feistel(cells: str, kind: str, key: str) -> str:
    """``cells``, an array of (x, r) with 0 <= x < r, keyed-permuted: in every
    round one half of the cells is shifted, cell by cell, by a keyed hash of the
    other half.  A single cell is split from nothing, so it is shifted by the key."""
    inside = "(k < size(v) div 2) = (i % 2 = 0)"
    other = f"array_join(transform(filter(v, (s, k) -> NOT ({inside})), s -> cast(s.x AS string)), ',')"
    seed = f"sha2(concat_ws('|', {sql(key)}, '{kind}', cast(i AS string), {other}), 512)"
    shift = "cast(conv(substring(d, 1 + 8 * cast(k % 16 AS int), 8), 16, 10) AS bigint)"
    moved = (
        f"transform(v, (s, k) -> CASE WHEN {inside} THEN "
        f"named_struct('x', pmod(s.x + {shift}, s.r), 'r', s.r) ELSE s END)"
    )
    return f"aggregate(sequence(0, {ROUNDS - 1}), {cells}, (v, i) -> element_at(transform(array({seed}), d -> {moved}), 1))"


def radix(*pairs: tuple[str, str]) -> str:
    return "array(" + ", ".join(f"named_struct('x', cast({x} AS bigint), 'r', cast({r} AS bigint))" for x, r in pairs) + ")"


def digits(cells: str) -> str:
    return f"transform({cells}, s -> cast(s.x AS string))"


def chars(text: str, low: int = 26) -> str:
    """Letters and digits of a text as cells of their class."""
    own = f"filter(split({text}, ''), c -> c RLIKE '^[0-9A-Za-z]$')"
    return (
        f"transform({own}, c -> CASE WHEN c BETWEEN '0' AND '9' THEN named_struct('x', cast(ascii(c) - 48 AS bigint), 'r', 10L) "
        f"WHEN c BETWEEN 'a' AND 'z' THEN named_struct('x', cast(ascii(c) - 97 AS bigint), 'r', {low}L) "
        "ELSE named_struct('x', cast(ascii(c) - 65 AS bigint), 'r', 26L) END)"
    )


def fill(form: str, values: str, which: str = "[0-9]") -> str:
    """``form`` with its characters of a class replaced by ``values`` in turn; a
    value for a letter is its place in the alphabet."""
    put = (
        "CASE WHEN c BETWEEN '0' AND '9' THEN element_at(a.v, a.k) "
        "WHEN c BETWEEN 'a' AND 'z' THEN chr(97 + cast(element_at(a.v, a.k) AS bigint)) "
        "ELSE chr(65 + cast(element_at(a.v, a.k) AS bigint)) END"
    )
    return (
        f"aggregate(split({form}, ''), named_struct('o', '', 'k', 1, 'v', {values}), (a, c) -> "
        f"CASE WHEN c RLIKE '^{which}$' THEN named_struct('o', concat(a.o, {put}), 'k', a.k + 1, 'v', a.v) "
        "ELSE named_struct('o', concat(a.o, c), 'k', a.k, 'v', a.v) END, a -> a.o)"
    )


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def plain(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '')"


def padded(value: str, width: int) -> str:
    return f"lpad(cast({value} AS string), {width}, '0')"


def letters(text: str) -> str:
    return f"split({text}, '')"


def pseudonym_card(key: str) -> str:
    body = let(digits(feistel(chars("substring(n, 1, length(n) - 1)"), "card", key)), "w", "array_join(w, '')")
    check = "filter(split('0123456789', ''), d -> d <> '' AND luhn_check(concat(b, d)))"
    whole = let(body, "b", fill("p", letters(f"concat(b, element_at({check}, 1))")))
    return let(plain("p"), "n", f"CASE WHEN luhn_check(n) THEN {whole} ELSE p END")


def pseudonym_phone(key: str) -> str:
    ten = digits(feistel(chars("regexp_replace(right(p, length(p) - h), '[^0-9]', '')"), "phone", key))
    return let("CASE WHEN p LIKE '+1%' THEN 2 ELSE 0 END", "h", f"concat(left(p, h), {fill('right(p, length(p) - h)', ten)})")


def pseudonym_ssn(key: str) -> str:
    area, group, serial = (f"cast(substring(n, {a}, {b}) AS int)" for a, b in ((1, 3), (4, 2), (6, 4)))
    valid = f"{area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0"
    cells = radix((f"{area} - 1 - CASE WHEN {area} > 666 THEN 1 ELSE 0 END", f"{SSN[0]}"), (f"{group} - 1", f"{SSN[1]}"), (f"{serial} - 1", f"{SSN[2]}"))
    new_area = padded("v[0].x + 1 + CASE WHEN v[0].x >= 665 THEN 1 ELSE 0 END", 3)
    out = let(feistel(cells, "ssn", key), "v", fill("p", letters(f"concat({new_area}, {padded('v[1].x + 1', 2)}, {padded('v[2].x + 1', 4)})")))
    return let(plain("p"), "n", f"CASE WHEN {valid} THEN {out} ELSE p END")


def pseudonym_ip(key: str) -> str:
    cells = "transform(split(p, '[.]'), o -> named_struct('x', cast(o AS bigint), 'r', 256L))"
    return f"array_join({digits(feistel(cells, 'ip', key))}, '.')"


def pseudonym_date(key: str, parts: tuple[int, int, int], order: str) -> str:
    """``parts``: where year, month and day begin among the digits."""
    y, m, d = (f"substring(n, {at}, {width})" for at, width in zip(parts, (4, 2, 2), strict=True))
    day = f"try_to_date(concat({y}, '-', {m}, '-', {d}), 'yyyy-MM-dd')"
    index = f"datediff(t, DATE'{FIRST_DAY}')"
    cells = radix((f"{index} div {DAYS[1]}", f"{DAYS[0]}"), (f"{index} % {DAYS[1]}", f"{DAYS[1]}"))
    moved = f"date_add(DATE'{FIRST_DAY}', cast(v[0].x * {DAYS[1]} + v[1].x AS int))"
    out = let(feistel(cells, "date", key), "v", fill("p", letters(f"date_format({moved}, '{order}')")))
    valid = f"t IS NOT NULL AND year(t) BETWEEN 1900 AND 2099"
    return let(plain("p"), "n", let(day, "t", f"CASE WHEN {valid} THEN {out} ELSE p END"))


def pseudonym_email(key: str) -> str:
    local = "substring_index(p, '@', 1)"
    new = fill(local, digits(feistel(chars(local), "email", key)), "[0-9A-Za-z]")
    return f"concat({new}, '@', substring_index(p, '@', -1))"


def pseudonym_secret(key: str) -> str:
    return fill("p", digits(feistel(chars("p", 6), "secret", key)), "[0-9a-f]")


def piece(key: str) -> str:
    """SQL for the pseudonym of a piece ``p``; other pieces stay."""
    ways = {
        "email": pseudonym_email(key),
        "phone": pseudonym_phone(key),
        "ssn": pseudonym_ssn(key),
        "iso": pseudonym_date(key, (1, 5, 7), "yyyyMMdd"),
        "dmy": pseudonym_date(key, (5, 3, 1), "ddMMyyyy"),
        "mdy": pseudonym_date(key, (5, 1, 3), "MMddyyyy"),
        "ip": pseudonym_ip(key),
        "card": pseudonym_card(key),
    }
    cases = " ".join(f"WHEN p RLIKE {sql('^(?:' + FORMS[k] + ')$')} THEN {way}" for k, way in ways.items())
    secret = f"WHEN p RLIKE '^[0-9a-f]{{16,64}}$' AND p RLIKE '[0-9]' AND p RLIKE '[a-f]' THEN {pseudonym_secret(key)}"
    # Numbers, dates and secrets have seven characters or more; addresses can be shorter.
    return f"CASE WHEN length(p) < 7 AND instr(p, '@') = 0 THEN p {cases} {secret} ELSE p END"


def pseudonymised(key: str, text: str = "text") -> Column:
    """The pseudonymised text of a string column."""
    found = f"regexp_extract_all({text}, {sql(PIECE)}, 0)"
    return F.expr(f"CASE WHEN {text} RLIKE {sql(ANY)} THEN array_join(transform({found}, p -> {piece(key)}), '') ELSE {text} END")


def session_key(spark: SparkSession, default: str | None = None) -> str:
    """The key in the session's settings, or the caller's default."""
    key = spark.conf.get(SETTING, None) or default
    if not key:
        raise ValueError(f"no key: set {SETTING}, or pass one")
    return key


def pseudonymise(docs: DataFrame, key: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, by ``key`` or the one in the session's
    settings (without either the call fails); a numeric ``n_chars`` follows the text's
    length, all else stays.  Null and empty texts stay; rows are independent, so
    repeated ids, null ids and extra columns are no special case."""
    name = "__new"
    while name in docs.columns:
        name += "_"
    out = docs.withColumn(name, pseudonymised(key or session_key(docs.sparkSession)))
    grown = (F.col("n_chars") + F.length(name) - F.length("text")) if dict(docs.dtypes).get("n_chars") in ("int", "bigint") else None
    columns = []
    for c, kind in docs.dtypes:
        if c == "text":
            columns.append(F.col(name).alias("text"))
        elif c == "n_chars" and grown is not None:
            columns.append(F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(grown).cast(kind).alias("n_chars"))
        else:
            columns.append(F.col(f"`{c}`"))
    return out.select(*columns)
