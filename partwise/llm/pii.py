"""Format-preserving pseudonyms for personal data, by keyed Feistel rounds in SQL expressions.

One pattern finds candidates; what passes its kind's check is replaced, and the rest stays as it was.
Text around and between the candidates is never changed. A value's pseudonym depends on the key, the
kind and the value alone, so equal values stay equal in all documents, and different ones different.

Numbers stand beside numbers, so a card is sought at every group of digits, in the forms of `SHAPES` and
as a whole run of groups. What passes Luhn is put into the row's own pattern, literally: the pattern
then takes no group from a card, and no run that fails its check hides one.

| kind | candidate | check | what is permuted |
| --- | --- | --- | --- |
| email | local@domain | shape | letters and digits of the local part, and of the domain but for its last label |
| card | 13 to 19 digits, also with single spaces or hyphens | Luhn | all digits but the last, which becomes the check digit |
| iban | two letters, two digits, 11 to 30 more | remainder 1 by 97 | what follows the check digits, which are made anew |
| phone | + with 8 to 15 digits, the most whole groups, or (ddd) ddd-dddd, ddd-ddd-dddd | number of digits | all digits but a country code set apart from the rest |
| ssn | ddd-dd-dddd | area, group and serial in use | the number among all valid ones |
| ip | four numbers by dots | each up to 255 | the 32 bits |
| date | yyyy-mm-dd, dd/mm/yyyy, dd.mm.yyyy, years 1900 to 2099 | is a day | the day, among all days of these years |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "card", "iban", "phone", "ssn", "ip", "date")
# A phone number has at most 15 digits, which end where a group does.
AT_MOST_15 = "(?<!" + "[0-9][ ()-]{0,3}" * 15 + "[0-9])"
AFTER_8 = "(?<=" + "[0-9][ ()-]{0,3}" * 7 + "[0-9][ -])"
ISO_DAY = r"(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9/-])"


def _phone(cards: str) -> str:
    """Pattern of phone numbers, none of which runs on into one of the given cards or, once long enough, a day."""

    def plus(gap: str, end: str) -> str:
        return (
            rf"(?<![0-9A-Za-z+])\+[0-9]{{1,3}}{gap}(?:\([0-9]{{1,4}}\){gap})?[0-9]{{2,4}}(?:{gap}[0-9]{{2,4}}){{1,4}}{end}{AT_MOST_15}"
        )

    return (
        r"(?<![0-9A-Za-z+])\+1[ -]?\([0-9]{3}\)[ -]?[0-9]{3}-[0-9]{4}(?![0-9])"
        + "|" + plus("[ -]?", "(?![0-9]|[ -][0-9])")
        + "|" + plus(rf"(?:[ -](?!{cards}|{AFTER_8}{ISO_DAY}))?", "(?![0-9])")
        + r"|(?<![0-9A-Za-z)])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])"
    )


# Every alternative starts where a run of its characters starts, so no text is scanned twice.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "phone": _phone("(?!)"),
    "ssn": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "date": r"(?<![0-9A-Za-z./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}"
    r"|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2})(?![0-9/-])",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]|[ -][0-9])",
}
CANDIDATE = "|".join(p for k, p in PATTERNS.items() if k != "card")
# Digits in each group of a card beside other numbers; of two that begin together the longer one.
SHAPES = ((4, 4, 4, 4, 3), (4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 3, 3, 3), (6, 13))
GROUP = r"(?:(?<![0-9A-Za-z.-])|(?<=[0-9]-))"
ROUNDS = 8
FIRST_DAY, YEARS, DAYS = "1900-01-01", 200, 73_049
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _prf(key: str, tweak: Column, number: Column, length: int = 12) -> Column:
    """A keyed non-negative BIGINT."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, F.lit("|"), number, F.lit(key)), 256)
    return F.conv(F.substring(digest, 1, length), 16, 10).cast("bigint")


def permuted_number(x: Column, a: int, b: int, key: str, tweak: str) -> Column:
    """x in [0, a * b) permuted: its two digits in base (a, b) take turns in being moved by the other."""

    def turn(pair: Column, i: Column) -> Column:
        left, right = pair["l"], pair["r"]
        mark = F.concat(F.lit(tweak), i.cast("string"))
        return F.when(
            i % 2 == 0,
            F.struct(((left + _prf(key, mark, right)) % a).alias("l"), right.alias("r")),
        ).otherwise(F.struct(left.alias("l"), ((right + _prf(key, mark, left)) % b).alias("r")))

    x = x.cast("bigint")
    start = F.struct((x / b).cast("bigint").alias("l"), (x % b).alias("r"))
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, start, turn, lambda pair: pair["l"] * b + pair["r"])


def permuted_text(x: Column, key: str, tweak: str) -> Column:
    """Digits become digits, small letters small ones, capitals capitals; all else stays in its place.

    The two halves take turns: each character moves by a keyed number made of a digest of the whole other
    half, which is taken once a turn, so the work is linear in the length.
    """

    def moved(half: Column, other: Column, mark: Column) -> Column:
        def one(c: Column, i: Column, stream: Column) -> Column:
            by = _prf(key, i.cast("string"), stream)
            digit, small, capital = c.rlike("^[0-9]$"), c.rlike("^[a-z]$"), c.rlike("^[A-Z]$")
            return (
                F.when(digit, ((c.cast("int") + by) % 10).cast("string"))
                .when(small, F.lower(_letter(F.instr(F.lit(LETTERS), F.upper(c)) - 1 + by)))
                .when(capital, _letter(F.instr(F.lit(LETTERS), c) - 1 + by))
                .otherwise(c)
            )

        digest = F.sha2(F.concat_ws("|", F.lit(key), mark, F.lit("|"), other, F.lit(key)), 256)
        # an array of one, so that its digest is evaluated once and not for each character
        texts = F.transform(
            F.array(digest), lambda stream: F.array_join(F.transform(F.split(half, "", -1), lambda c, i: one(c, i, stream)), "")
        )
        return F.get(texts, F.lit(0))

    def turn(pair: Column, i: Column) -> Column:
        left, right = pair["l"], pair["r"]
        mark = F.concat(F.lit(tweak), i.cast("string"))
        return F.when(
            i % 2 == 0, F.struct(moved(left, right, mark).alias("l"), right.alias("r"))
        ).otherwise(F.struct(left.alias("l"), moved(right, left, mark).alias("r")))

    half = F.floor(F.length(x) / 2).cast("int")
    start = F.struct(x.substr(F.lit(1), half).alias("l"), x.substr(half + 1, F.length(x)).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda p: F.concat(p["l"], p["r"]))


def _letter(n: Column) -> Column:
    return F.substring(F.lit(LETTERS), (n % 26 + 1).cast("int"), F.lit(1))


def _in_shape(shape: Column, digits: Column) -> Column:
    """shape with its digits replaced, in order, by the given ones."""
    cut = F.split(shape, "[0-9]", -1)
    return F.array_join(F.transform(cut, lambda part, i: F.concat(part, F.substring(digits, i + 1, F.lit(1)))), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits whose last one counts once."""
    backwards = F.split(F.reverse(digits), "", -1)
    each = F.transform(
        backwards, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))
    )
    return F.aggregate(each, F.lit(0), lambda a, b: a + b)


def _mod97(text: Column) -> Column:
    """Remainder by 97 of a text in which A is 10 and Z is 35."""

    def step(left: Column, c: Column) -> Column:
        letter = F.instr(F.lit(LETTERS), c)
        return F.when(letter > 0, (left * 100 + letter + 9) % 97).otherwise((left * 10 + c.cast("int")) % 97)

    return F.aggregate(F.split(text, "", -1), F.lit(0), step)


def _kind(m: Column) -> Column:
    """The kind of a candidate that passes its check, else null."""
    digits, n = _digits(m), F.length(_digits(m))
    day = _day(m)
    ssn = F.split(m, "-")
    whole = {k: m.rlike(f"^(?:{p})$") for k, p in PATTERNS.items()}
    checks = {
        "email": F.lit(True),
        "iban": _mod97(F.concat(F.substring(m, 5, 40), F.substring(m, 1, 4))) == 1,
        "phone": (n >= 8) & (n <= 15),
        "ssn": ~ssn[0].isin("000", "666") & (ssn[0] < "900") & (ssn[1] != "00") & (ssn[2] != "0000"),
        "date": day.isNotNull(),
        "ip": F.forall(F.split(m, r"\."), lambda part: part.cast("int") < 256),
        "card": _luhn_sum(digits) % 10 == 0,
    }
    kind = F.lit(None).cast("string")
    for k in reversed(PATTERNS):
        kind = F.when(whole[k] & checks[k], F.lit(k)).otherwise(kind)
    return kind


def _day(m: Column) -> Column:
    iso, sep = m.rlike("^[0-9]{4}-"), F.when(m.contains("/"), "/").otherwise(".")
    turned = F.concat(F.substring(m, 7, 4), F.lit("-"), F.substring(m, 4, 2), F.lit("-"), F.substring(m, 1, 2))
    plain = m.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$|^[0-9]{2}([/.])[0-9]{2}\1[0-9]{4}$") & sep.isNotNull()
    return F.when(plain, F.try_to_date(F.when(iso, m).otherwise(turned), "yyyy-MM-dd"))


def _any_of(values: Column) -> Column:
    """Pattern of any of these texts of digits, spaces and hyphens."""
    return F.when(F.size(values) > 0, F.concat(F.lit("(?:"), F.array_join(values, "|"), F.lit(")"))).otherwise("(?!)")


def _candidate(text: Column) -> Column:
    """The pattern of a text's candidates, in which its cards stand literally."""
    end = "(?![0-9A-Za-z])"

    def cards(pattern: str) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
        return F.filter(found, lambda m: _luhn_sum(_digits(m)) % 10 == 0)

    start, body = PATTERNS["card"].split("[0-9](?:", 1)
    lists = [cards(f"{GROUP}(?=([0-9]{{13,19}}){end})")]
    lists += [cards(f"{GROUP}(?=({'[ -]'.join(f'[0-9]{{{n}}}' for n in s)}){end})") for s in SHAPES]
    lists += [cards(f"{start}(?=([0-9](?:{body}))")]

    def pattern(c: Column) -> Column:
        single, shaped, whole = c[0], [c[i + 1] for i in range(len(SHAPES))], c[len(SHAPES) + 1]
        # where two overlap, the one that begins as payment cards do
        likely = [F.filter(x, lambda m: m.rlike("^[2-6]")) for x in shaped]
        sure = F.concat(_any_of(F.concat(*likely, single)), F.lit(end))
        card = [F.lit(GROUP + "(?:"), _any_of(single)]
        for shape, x, good in zip(SHAPES, shaped, likely):
            other = F.filter(x, lambda m: ~m.rlike("^[2-6]"))
            card += [F.lit("|"), _any_of(good), F.lit(end)]
            card += [F.lit(f"|(?!(?:[0-9]++[ -]){{1,{len(shape) - 1}}}"), sure, F.lit(")"), _any_of(other), F.lit(end)]
        card += [F.lit(f"){end}|{start}(?!(?:[0-9]++[ -]){{1,18}}"), sure, F.lit(")"), _any_of(whole), F.lit("(?![0-9A-Za-z]|[ -][0-9])")]
        # a card with a + before it is none of a phone's groups
        phone = _phone("@")
        cut = phone.split("@")
        phones = F.concat(F.lit(cut[0]), *[x for part in cut[1:] for x in (sure, F.lit(part))])
        rest = [F.lit(f"|{p}") for k, p in PATTERNS.items() if k not in ("email", "iban", "phone", "card")]
        return F.concat(F.lit(f"{PATTERNS['email']}|{PATTERNS['iban']}|"), phones, *rest, F.lit("|"), *card)

    found = F.array(*lists)
    made = F.transform(F.array(found), lambda c: F.when(F.size(F.flatten(c)) > 0, pattern(c)).otherwise(CANDIDATE))[0]
    return F.when(text.rlike("[0-9](?:[ -]?[0-9]){12}"), made).otherwise(CANDIDATE)


def _pseudonym(m: Column, kind: Column, key: str) -> Column:
    digits = _digits(m)

    def text(x: Column, tweak: str) -> Column:
        return permuted_text(x, key, tweak)

    at = F.instr(m, "@")
    domain = F.regexp_extract(m, r"@(.*)\.[^.]*$", 1)
    email = F.concat(
        text(m.substr(F.lit(1), at - 1), "local"), F.lit("@"), text(domain, "domain"), F.regexp_extract(m, r"(\.[^.@]*)$", 1)
    )

    body = text(F.regexp_replace(digits, "[0-9]$", ""), "card")
    check = (10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    card = _in_shape(m, F.concat(body, check.cast("string")))

    account = text(F.substring(m, 5, 40), "iban")
    country = F.substring(m, 1, 2)
    iban = F.concat(country, F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)

    code = F.regexp_extract(m, r"^(\+[0-9]{1,3}[ -]?(?=[( -]|[0-9 -]*$))", 1)
    code = F.when(code.rlike("[ -]$") | F.substring(m, F.length(code) + 1, F.lit(1)).isin("(", " ", "-"), code).otherwise("+")
    code = F.when(m.startswith("+"), code).otherwise("")
    number = m.substr(F.length(code) + 1, F.length(m))
    phone = F.concat(code, _in_shape(number, text(_digits(number), "phone")))

    area = F.substring(digits, 1, 3).cast("int")
    index = (area - F.when(area > 666, 2).otherwise(1)).cast("bigint") * (99 * 9999)
    index = index + (F.substring(digits, 4, 2).cast("int") - 1) * 9999 + (F.substring(digits, 6, 4).cast("int") - 1)
    new = permuted_number(index, 898, 99 * 9999, key, "ssn")
    new_area = (new / (99 * 9999)).cast("int") + 1
    new_area = F.when(new_area >= 666, new_area + 1).otherwise(new_area)
    ssn = F.concat_ws(
        "-", F.lpad(new_area.cast("string"), 3, "0"),
        F.lpad(((new % (99 * 9999) / 9999).cast("int") + 1).cast("string"), 2, "0"),
        F.lpad((new % 9999 + 1).cast("string"), 4, "0"),
    )

    parts = F.split(m, r"\.")
    bits = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, p: a * 256 + p.cast("bigint"))
    moved = permuted_number(bits, 65_536, 65_536, key, "ip")
    ip = F.concat_ws(".", *[F.shiftright(moved, s).bitwiseAND(F.lit(255).cast("bigint")).cast("string") for s in (24, 16, 8, 0)])

    # The days are 200 * 365 and 7 * 7 more; each part is permuted in itself.
    n = F.datediff(_day(m), F.lit(FIRST_DAY).cast("date")).cast("bigint")
    most = YEARS * 365
    day = F.date_add(
        F.lit(FIRST_DAY).cast("date"),
        F.when(n < most, permuted_number(n, YEARS, 365, key, "day"))
        .otherwise(most + permuted_number(n - most, 7, 7, key, "late day")).cast("int"),
    )
    date = F.when(m.contains("/"), F.date_format(day, "dd/MM/yyyy")).when(
        m.contains("."), F.date_format(day, "dd.MM.yyyy")
    ).otherwise(F.date_format(day, "yyyy-MM-dd"))

    made = {"email": email, "card": card, "iban": iban, "phone": phone, "ssn": ssn, "ip": ip, "date": date}
    out = m
    for k in KINDS:
        out = F.when(kind == k, made[k]).otherwise(out)
    return out


def unused(columns: list[str], name: str) -> str:
    """name, with as many underscores before it as make it none of columns (case aside)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", counts: str = "pii_counts") -> DataFrame:
    """docs with personal data in text_col replaced, and `counts`, a map from kind to how many were.

    Null stays null and empty stays empty, with an empty map; repeated rows give equal rows; all other
    columns are kept, except one named like `counts`, which is replaced. No row is added or dropped.
    """
    text = F.col(text_col)
    found_col, new_col = unused(docs.columns, "_found"), unused(docs.columns, "_new")
    # whole texts without a digit or @ are passed on without the search
    likely = text.rlike("[0-9@]")
    pattern = F.col(found_col)["pattern"]
    found = F.when(likely, F.regexp_extract_all(text, pattern, F.lit(0)))
    changed = F.transform(
        found,
        lambda m: F.struct(
            m.alias("was"), _kind(m).alias("kind")
        ),
    )
    replaced = F.transform(
        F.col(found_col)["all"], lambda c: F.struct(c["kind"].alias("kind"), _pseudonym(c["was"], c["kind"], key).alias("now"))
    )
    between = F.split(text, pattern, -1)
    joined = F.array_join(
        F.transform(between, lambda part, i: F.concat(part, F.coalesce(F.get(F.col(new_col), i)["now"], F.lit("")))), ""
    )
    kinds = F.filter(F.transform(F.col(new_col), lambda c: c["kind"]), lambda k: k.isNotNull())
    n_by_kind = F.map_from_entries(
        F.transform(
            F.array_sort(F.array_distinct(kinds)),
            lambda k: F.struct(k, F.size(F.filter(kinds, lambda other: other == k)).cast("bigint")),
        )
    )
    none = F.create_map().cast("map<string,bigint>")
    rest = [_named(c) for c in docs.columns if c not in (text_col, counts)]
    return (
        docs.withColumn(found_col, F.struct(F.when(likely, _candidate(text)).alias("pattern")))
        .withColumn(found_col, F.struct(pattern.alias("pattern"), changed.alias("all")))
        .withColumn(new_col, replaced)
        .select(
            *rest,
            F.when(F.size(new_col) > 0, joined).otherwise(text).alias(text_col),
            F.when(F.size(new_col) > 0, n_by_kind).otherwise(none).alias(counts),
        )
        .select(*[_named(c) for c in docs.columns if c != counts], counts)
    )
