"""PII: format-preserving Feistel pseudonyms (DataFrame functions only).

Numbers, dates and addresses are found by pattern and validated; each valid
one is replaced by a keyed permutation of itself within its format: digits
stay digits, separators stay where they are, check digits are right, dates
are dates. Equal values get equal pseudonyms in all documents, whatever
their separators; unequal values of a kind never meet.

Two Feistel networks do it, both with SHA-2 of the key as round function:
over the characters of a string (each half's letters and digits are shifted
within their class by a hash of the other half) and over integers (halves
of the bits). Values that leave the valid set are permuted again until they
are back (cycle walking), which keeps the permutation one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
STRETCH = 256  # numbers of a run whose pieces are put together at a time
WALK = 400  # steps of a cycle walk; every kind leaves it in a few
FIRST_DAY, LAST_DAY = "1900-01-01", "2099-12-31"
KINDS = ("email", "date", "ip", "ssn", "phone", "card")
END = r"(?!\w|[.+-]\w)"
LOOSE_END = r"(?!\w|[.+]\w)"
DATE = r"\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4}"
SSN = r"\d{3}-\d{2}-\d{4}"
NATIONAL = r"\d{3}[ .-]\d{3}[ .-]\d{4}"
CARD = r"(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)"
PATTERN = (
    r"(?<![\w.@+-])(?:"
    # Bounded as addresses are (a domain has 253 characters, so 126 labels at
    # most), so a text of labels or of %-codes is neither recursed into nor read again from every place.
    r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,255}+@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,63}" + LOOSE_END +
    rf"|(?:{DATE})(?=[Tt]\d{{2}}(?!\d))"
    r"|(?:" + DATE +
    r"|\d{1,3}(?:\.\d{1,3}){3}"
    r"|" + SSN +
    rf"|\+\d{{1,3}}[ .-]?\(?\d{{2,4}}\)?(?:(?![ .-]{CARD})[ .-]?\d{{2,4}}){{2,4}}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|" + NATIONAL +
    r")" + END +
    # A whole run of numbers, of which cards are taken later; dates and other kinds after it are none of it.
    rf"|(?=\d(?:[ -]?\d){{12}})\d++{LOOSE_END}(?:[ -](?!(?:{DATE}|{SSN}|{NATIONAL}){END})\d++{LOOSE_END})*+"
    r")"
)
DATE_FORMATS = ((r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{4}/", "yyyy/MM/dd"), (r"^\d{2}\.", "dd.MM.yyyy"), (r"^\d{2}/", "dd/MM/yyyy"))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def steps(n: int) -> Column:
    return F.array(*[F.lit(i) for i in range(n)])


def shifted(part: Column, digest: Column) -> Column:
    """Each letter or digit of ``part``, moved within its class by 16 bits of the digest."""
    def move(c: Column, i: Column) -> Column:
        by = F.conv(F.substr(digest, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")

        def within(first: int, size: int) -> Column:
            return F.chr(F.lit(first) + (F.ascii(c) - first + by) % size)

        return (F.when(c.between("0", "9"), within(48, 10)).when(c.between("a", "z"), within(97, 26))
                .when(c.between("A", "Z"), within(65, 26)).otherwise(c))

    return F.array_join(F.transform(F.split(part, ""), move), "")


def permute_text(s: Column, key: Column, kind: str) -> Column:
    """Feistel network over the two halves of a string; a single character is only shifted."""
    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), half).alias("a"), F.substr(s, half + 1, F.length(s)).alias("b"))

    def turn(x: Column, i: Column) -> Column:
        def digest(other):
            return F.sha2(F.concat_ws("|", key, F.lit(kind), i.cast("string"), F.length(s).cast("string"), other), 512)

        even = i % 2 == 0
        return F.struct(F.when(even, shifted(x["a"], digest(x["b"]))).otherwise(x["a"]).alias("a"),
                        F.when(even, x["b"]).otherwise(shifted(x["b"], digest(x["a"]))).alias("b"))

    return F.aggregate(steps(ROUNDS), start, turn, lambda x: F.concat(x["a"], x["b"]))


def permute_int(v: Column, bits: int, key: Column, kind: str) -> Column:
    """Feistel network over the halves of a number of ``bits`` (even) bits."""
    half = bits // 2
    mask = (1 << half) - 1
    start = F.struct(F.shiftright(v, half).alias("a"), v.bitwiseAND(F.lit(mask).cast("long")).alias("b"))

    def turn(x: Column, i: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", key, F.lit(kind), i.cast("string"), x["b"].cast("string")), 256)
        f = F.conv(F.substr(digest, F.lit(1), F.lit(8)), 16, 10).cast("long").bitwiseAND(F.lit(mask).cast("long"))
        return F.struct(x["b"].alias("a"), x["a"].bitwiseXOR(f).alias("b"))

    return F.aggregate(steps(ROUNDS), start, turn, lambda x: F.shiftleft(x["a"], half).bitwiseOR(x["b"]))


def walk(v: Column, step: Callable[[Column], Column], valid: Callable[[Column], Column]) -> Column:
    """Permute once, then on until the value is valid."""
    start = F.struct(step(v).alias("v"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start,
                       lambda x, _: F.when(valid(x["v"]), x).otherwise(F.struct(step(x["v"]).alias("v"))),
                       lambda x: x["v"])


def check_digit(body: Column) -> Column:
    """Luhn check digit of a string of digits."""
    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.transform(F.split(F.reverse(body), ""), weigh), F.lit(0), lambda n, x: n + x)
    return ((10 - total % 10) % 10).cast("string")


def put_digits(template: Column, value: Column) -> Column:
    """``template`` with its digits replaced by those of ``value``, in order."""
    def put(i: Column) -> Column:
        c = F.substr(template, i, F.lit(1))
        nth = F.length(digits(F.substr(template, F.lit(1), i)))
        return F.when(c.between("0", "9"), F.substr(value, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(template)), put), "")


def parsed(m: Column) -> Column:
    out = F.lit(None).cast("date")
    for form, fmt in reversed(DATE_FORMATS):
        out = F.when(m.rlike(form), F.try_to_timestamp(m, F.lit(fmt)).cast("date")).otherwise(out)
    return out


def as_written(day: Column, m: Column) -> Column:
    out = F.lit(None).cast("string")
    for form, fmt in reversed(DATE_FORMATS):
        out = F.when(m.rlike(form), F.date_format(day, fmt)).otherwise(out)
    return out


def ssn_valid(d: Column) -> Column:
    return d.rlike("^(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}$")


def national_valid(d: Column) -> Column:
    return d.rlike("^[2-9][0-9]{2}[2-9][0-9]{6}$")


def north_american(m: Column) -> Column:
    return ~m.startswith("+") | ((F.length(digits(m)) == 11) & m.startswith("+1"))


def kind_of(m: Column) -> Column:
    """The kind of a match, null if it isn't valid."""
    d = digits(m)
    day = parsed(m)
    return (F.when(m.contains("@"), F.lit("email"))
            .when(m.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})$"),
                  F.when(day.between(F.to_date(F.lit(FIRST_DAY)), F.to_date(F.lit(LAST_DAY))), F.lit("date")))
            .when(m.rlike(r"^\d+(\.\d+){3}$"), F.when(F.forall(F.split(m, r"\."), lambda x: x.cast("int") <= 255), F.lit("ip")))
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.when(ssn_valid(d), F.lit("ssn")))
            .when(m.rlike(r"^[+(]") | (F.length(d) == 10),
                  F.when(F.when(north_american(m), national_valid(F.right(d, F.lit(10))))
                         .otherwise(F.length(d).between(8, 15)), F.lit("phone")))
            .when(F.length(d).between(13, 19), F.when(
                check_digit(F.substr(d, F.lit(1), F.length(d) - 1)) == F.right(d, F.lit(1)), F.lit("card"))))


def is_card(s: Column) -> Column:
    """Whether ``s`` is digits with single separators and a right check digit."""
    shaped = F.filter(F.array(s), lambda x: x.rlike(r"^[0-9](?:[ -]?[0-9]){12,18}$"))
    return F.exists(F.transform(shaped, digits),
                    lambda d: check_digit(F.substr(d, F.lit(1), F.length(d) - 1)) == F.right(d, F.lit(1)))


def cards_within(m: Column) -> Column:
    """The pieces (was, kind) of a run of numbers that is no valid value whole:
    from the left, the numbers that together are a card (plain shapes first,
    then the longest), and what is between them."""
    numbers = F.regexp_extract_all(m, F.lit("[^0-9]*[0-9]+"), F.lit(0))

    def joined(x: Column, i: Column, k: Column) -> Column:
        return F.regexp_replace(F.array_join(F.slice(x, i + 1, k), ""), "^[^0-9]+", "")

    def length(x: Column, i: Column) -> Column:
        left = F.least(F.lit(19), F.size(x) - i)
        plain = F.filter(F.array(*[F.lit(k) for k in (4, 3, 1)]), lambda k: F.when(
            k <= left, joined(x, i, k).rlike(f"^{CARD}$") & is_card(joined(x, i, k))).otherwise(False))
        loose = F.filter(F.sequence(left, F.lit(1), F.lit(-1)), lambda k: is_card(joined(x, i, k)))
        return F.coalesce(F.get(plain, F.lit(0)), F.get(loose, F.lit(0)), F.lit(0))

    piece = "struct<was:string,kind:string>"

    def row(was: Column, kind: Column) -> Column:
        return F.struct(was.alias("was"), kind.cast("string").alias("kind"))

    def step(x: Column):
        def turn(state: Column, at: Column) -> Column:
            i, k = at["i"], at["k"]
            number = F.get(x, i)
            none = F.lit(None)
            more = F.when(k > 0, F.array(row(F.regexp_extract(number, "^[^0-9]*", 0), none), row(joined(x, i, k), F.lit("card")))
                          ).otherwise(F.array(row(number, none)))
            return (F.when(state["skip"] > 0, F.struct((state["skip"] - 1).alias("skip"), state["out"].alias("out")))
                    .otherwise(F.struct(F.greatest(k - 1, F.lit(0)).alias("skip"), F.concat(state["out"], more).alias("out"))))
        return turn

    def split(x: Column) -> Column:
        # In two levels, as an array that grows by one piece at a time is copied each time.
        def stretch(state: Column, first: Column) -> Column:
            places = F.sequence(first, F.least(first + STRETCH, F.size(x)) - 1)
            lengths = F.transform(places, lambda i: F.struct(i.alias("i"), length(x, i).alias("k")))
            start = F.struct(state["skip"].alias("skip"), none_yet.alias("out"))
            return F.aggregate(lengths, start, step(x), lambda more: F.struct(
                more["skip"].alias("skip"), F.concat(state["out"], more["out"]).alias("out")))

        none_yet = F.array().cast(f"array<{piece}>")
        firsts = F.sequence(F.lit(0), F.size(x) - 1, F.lit(STRETCH))
        return F.aggregate(firsts, F.struct(F.lit(0).alias("skip"), none_yet.alias("out")), stretch, lambda state: state["out"])

    return F.get(F.transform(F.array(numbers), split), F.lit(0))


def pseudonym(m: Column, kind: Column, key: Column) -> Column:
    d = digits(m)
    # Dates: days since the first one, by cycle walking over 2^18.
    origin = F.to_date(F.lit(FIRST_DAY))
    span = F.datediff(F.to_date(F.lit(LAST_DAY)), origin)
    day = walk(F.datediff(parsed(m), origin).cast("long"), lambda v: permute_int(v, 18, key, "date"), lambda v: v <= span)
    date = as_written(F.date_add(origin, day.cast("int")), m)
    octets = F.split(m, r"\.")
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda n, x: n * 256 + x.cast("long"))
    moved = F.struct(permute_int(number, 32, key, "ip").alias("v"))
    ip = F.aggregate(F.array(moved), F.lit(""), lambda _, x: F.concat_ws(
        ".", *[F.shiftright(x["v"], s).bitwiseAND(F.lit(255).cast("long")).cast("string") for s in (24, 16, 8, 0)]))
    ssn = put_digits(m, walk(d, lambda v: permute_text(v, key, "ssn"), ssn_valid))
    own = F.right(d, F.lit(10))
    country = F.substr(d, F.lit(1), F.length(d) - 10)
    plain = F.regexp_extract(m, r"^\+?([0-9]{1,3})", 1)
    rest = F.substr(d, F.length(plain) + 1, F.length(d))
    phone = put_digits(m, F.when(north_american(m), F.concat(country, walk(own, lambda v: permute_text(v, key, "phone"), national_valid)))
                       .otherwise(F.concat(plain, permute_text(rest, key, "abroad"))))
    body = F.concat(F.substr(d, F.lit(1), F.lit(1)), permute_text(F.substr(d, F.lit(2), F.length(d) - 2), key, "card"))
    card = put_digits(m, F.aggregate(F.array(body), F.lit(""), lambda _, x: F.concat(x, check_digit(x))))
    local = F.substring_index(m, "@", 1)
    email = F.concat(permute_text(local, key, "email"), F.lit("@"), F.substring_index(m, "@", -1))
    return (F.when(kind == "email", email).when(kind == "date", date).when(kind == "ip", ip)
            .when(kind == "ssn", ssn).when(kind == "phone", phone).when(kind == "card", card))


def pseudonymise(docs: DataFrame, key: str, *, text: str = "text", found: str = "pii_found") -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced, plus ``found``: an
    array of (kind, was, now) in text order.

    Valid are e-mail addresses, calendar dates from 1900 to 2099, IPv4
    addresses, social security numbers, phone numbers (North American ones
    by their numbering plan) and card numbers with a right check digit;
    anything else, and all other text, stays as it is. Null texts stay null
    and empty ones empty, with nothing found; very long texts are read
    whole; repeated rows change alike. An existing column ``found`` is
    replaced, other extra columns pass through; an empty table gives an
    empty result. There is no shuffle.
    """
    k = F.lit(key)
    names = [F.col(f"`{c}`") for c in docs.columns if c not in (text, found)]
    body = F.col(f"`{text}`").cast("string")
    matches = F.when(body.rlike("[0-9@]"), F.regexp_extract_all(body, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = docs.select(*names, body.alias("_text"), matches.alias("_m"))
    def told(x: Column) -> Column:
        whole = F.array(F.struct(x["was"].alias("was"), x["kind"].alias("kind")))
        run = x["kind"].isNull() & x["was"].rlike("^[+(0-9](?:[^0-9]*[0-9]){12}")
        return F.when(run, cards_within(x["was"])).otherwise(whole)

    kinds = F.transform("_m", lambda m: F.struct(m.alias("was"), kind_of(m).alias("kind")))
    rows = rows.withColumn("_m", F.when(F.size("_m") > 0, kinds))
    rows = rows.withColumn("_m", F.transform("_m", told))
    done = F.transform("_m", lambda xs: F.transform(xs, lambda x: F.struct(
        x["kind"].alias("kind"), x["was"].alias("was"), F.coalesce(pseudonym(x["was"], x["kind"], k), x["was"]).alias("now"))))
    rows = rows.withColumn("_m", done)
    pieces = F.split("_text", PATTERN, -1)
    woven = F.array_join(F.zip_with(pieces, F.transform("_m", lambda xs: F.array_join(F.transform(xs, lambda x: x["now"]), "")),
                                    lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")
    none = F.array().cast("array<struct<kind:string,was:string,now:string>>")
    return rows.select(*names, F.when(F.col("_m").isNull(), F.col("_text")).otherwise(woven).alias(text),
                       F.coalesce(F.filter(F.flatten("_m"), lambda x: x["kind"].isNotNull()), none).alias(found))
