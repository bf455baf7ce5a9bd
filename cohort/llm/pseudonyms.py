"""Format-preserving Feistel pseudonyms for personal numbers, dates and mail addresses.

Found and validated: payment cards (13 to 19 digits, Luhn), phone numbers of country code 1 (without
it, only with a possible area and exchange), social security numbers, IPv4 addresses, dates of 1900 to 2099 that exist in the calendar (y-m-d,
d.m.y, m/d/y, with - / or . between), and mail addresses. What fails validation stays.

A value becomes a point of its format's domain, written as two numbers below (a, b): middle
digits of a card, area + exchange and line of a phone, halves of an address, the day's
number (73049 = 17 * 4297 days). ``ROUNDS`` Feistel rounds add a keyed hash of one number to the other, modulo its
size, so the map is a permutation of the domain for every key: equal values get equal
pseudonyms in all documents, different ones stay different, and the key holder can
undo it. Written back, separators, lengths and validity are kept: cards keep their first digit
and get a fitting check digit, dates stay dates. The parts of a mail address before the
host's last two labels are permuted character by character within letters and digits by a Feistel network
over the halves of the string.

Only DataFrame functions run, in one narrow projection: equal values stay linked without any
exchange, because the pseudonym depends on the key and the value alone. The key is an argument;
it appears in query plans, so take it from a redacted setting and keep plans private.

Defined results: null stays null, empty stays empty; texts without validated values stay as they
are; a pseudonym may equal its value by chance (one in the domain's size); repeated
rows each give a row.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort.llm.common import pick
from cohort.llm.native import let, matches

ROUNDS = 10
KINDS = ("mail", "date", "ip", "ssn", "phone", "card")
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# No pattern can match inside another's match or inside a longer number.
PATTERNS = {
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9-])",
    "date": (r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}([-/.])(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12][0-9]|3[01])"
             r"|(?:0[1-9]|[12][0-9]|3[01])([-.])(?:0[1-9]|1[0-2])\2(?:19|20)[0-9]{2}"
             r"|(?:0[1-9]|1[0-2])/(?:0[1-9]|[12][0-9]|3[01])/(?:19|20)[0-9]{2})(?![0-9]|[./-][0-9])"),
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9]|-[0-9])",
    "phone": (r"(?<![0-9+])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9]|-[0-9])"
              r"|(?<![0-9+])(?:1[ .-])?(?:\([2-9][0-9]{2}\)[ .-]?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9]|-[0-9])"),
    "card": (r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\3[0-9]{4}\3[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\4[0-9]{5})(?![0-9])"),
}
# One pass needs one pattern; the back references count groups over all kinds.
ANY = "|".join(PATTERNS.values())
FIRST_DAY = "1900-01-01"


def prf(key: str, kind: Column | str, turn: Column, value: Column) -> Column:
    """60-bit keyed hash, nested so that the key stands on both sides."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    inner = F.sha2(F.concat_ws("|", F.lit(key), kind, turn.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(F.sha2(F.concat(F.lit(key), inner), 256), 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, left: Column, right: Column, a: Column, b: Column) -> Column:
    """``struct<x, y>``: a keyed permutation of the pairs x < a, y < b."""
    start = F.struct(left.cast("long").alias("x"), right.cast("long").alias("y"),
                     a.cast("long").alias("a"), b.cast("long").alias("b"))

    def turn(s: Column, i: Column) -> Column:
        moved = F.pmod(s["x"] + F.pmod(prf(key, kind, i, s["y"]), s["a"]), s["a"])
        return F.struct(s["y"].alias("x"), moved.alias("y"), s["b"].alias("a"), s["a"].alias("b"))

    # An even number of rounds leaves the sides as they stood.
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _padded(value: Column, width: Column) -> Column:
    return F.lpad(value.cast("string"), width, F.lit("0"))


def characters(value: Column) -> Column:
    """The characters of a string, one by one."""
    return F.filter(F.split(value, ""), lambda c: c != "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string (0 modulo 10 for a valid number)."""
    d = F.transform(characters(F.reverse(digits)), lambda c: c.cast("int"))
    doubled = F.transform(d, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x)


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    def run(pieces: Column) -> Column:
        zipped = F.zip_with(pieces, characters(digits), lambda p, d: F.concat(p, F.coalesce(d, F.lit(""))))
        return F.array_join(zipped, "")
    return let(F.split(shape, "[0-9]", -1), run)


def card(key: str, value: Column) -> Column:
    """Valid cards: first digit kept, middle permuted, check digit made to fit."""
    def middle(d: Column) -> Column:
        n = F.char_length(d) - 2
        u = F.floor(n / 2).cast("int")
        v = n - u
        power = lambda k: F.rpad(F.lit("1"), k + 1, F.lit("0")).cast("long")
        left, right = F.substring(d, F.lit(2), u), F.substring(d, u + 2, v)

        def write(s: Column) -> Column:
            body = F.concat(F.substring(d, 1, 1), _padded(s["x"], u), _padded(s["y"], v))
            return let(body, lambda x: F.concat(x, F.pmod(10 - luhn_sum(F.concat(x, F.lit("0"))) % 10, F.lit(10)).cast("string")))

        new = let(feistel(key, "card", left, right, power(u), power(v)), write)
        return F.when((luhn_sum(d) % 10 == 0) & ~d.rlike("^0+$"), refill(value, new)).otherwise(value)
    return let(_digits(value), middle)


def phone(key: str, value: Column) -> Column:
    """Area and exchange stay in 200 to 999, or below 200, as they were; a country code stays."""
    def run(d: Column) -> Column:
        lead = F.substring(d, F.lit(1), F.char_length(d) - 10)
        at = lambda i, n: F.substring(d, F.char_length(d) - 10 + i, F.lit(n)).cast("long")
        low = lambda x: F.when(x < 200, 0).otherwise(200)
        span = lambda x: F.when(x < 200, 200).otherwise(800)
        area, exchange = at(1, 3), at(4, 3)
        s = feistel(key, "phone", area - low(area), (exchange - low(exchange)) * 10000 + at(7, 4),
                    span(area), span(exchange) * 10000)
        return let(s, lambda s: refill(value, F.concat(
            lead, _padded(s["x"] + low(area), F.lit(3)), _padded(F.floor(s["y"] / 10000) + low(exchange), F.lit(3)),
            _padded(s["y"] % 10000, F.lit(4)))))
    return let(_digits(value), run)


def ssn(key: str, value: Column) -> Column:
    """Areas 001 to 899 without 666, groups from 01, serials from 0001."""
    def run(d: Column) -> Column:
        area = F.substring(d, 1, 3).cast("long")
        left = area - 1 - (area > 666).cast("long")
        right = (F.substring(d, 4, 2).cast("long") - 1) * 9999 + F.substring(d, 6, 4).cast("long") - 1
        return let(feistel(key, "ssn", left, right, F.lit(898), F.lit(99 * 9999)), lambda s: refill(value, F.concat(
            _padded(s["x"] + 1 + (s["x"] + 1 >= 666).cast("long"), F.lit(3)),
            _padded(F.floor(s["y"] / 9999) + 1, F.lit(2)), _padded(s["y"] % 9999 + 1, F.lit(4)))))
    return let(_digits(value), run)


def ip(key: str, value: Column) -> Column:
    """Any address to any address."""
    def run(o: Column) -> Column:
        part = lambda i: o[i].cast("long")
        return let(feistel(key, "ip", part(0) * 256 + part(1), part(2) * 256 + part(3), F.lit(65536), F.lit(65536)),
                   lambda s: F.concat_ws(".", *[x.cast("string") for x in (
                       F.floor(s["x"] / 256), s["x"] % 256, F.floor(s["y"] / 256), s["y"] % 256)]))
    return let(F.split(value, r"\."), run)


def date(key: str, value: Column) -> Column:
    """Existing days of 1900 to 2099 to others, in the same order and with the same separators."""
    year_first, slash = value.rlike("^[0-9]{4}"), value.contains("/")
    order = lambda y, m, d: F.when(year_first, F.concat(y, m, d)).when(slash, F.concat(m, d, y)).otherwise(F.concat(d, m, y))

    def run(d: Column) -> Column:
        cut = lambda i, n: F.substring(d, i, n)
        text = (F.when(year_first, F.concat_ws("-", cut(1, 4), cut(5, 2), cut(7, 2)))
                 .when(slash, F.concat_ws("-", cut(5, 4), cut(1, 2), cut(3, 2)))
                 .otherwise(F.concat_ws("-", cut(5, 4), cut(3, 2), cut(1, 2))))

        def moved(day: Column) -> Column:
            n = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
            s = feistel(key, "date", F.floor(n / 4297), n % 4297, F.lit(17), F.lit(4297))
            new = let(s, lambda s: F.date_add(F.lit(FIRST_DAY).cast("date"), (s["x"] * 4297 + s["y"]).cast("int")))
            iso = let(new.cast("string"), lambda t: refill(value, order(
                F.substring(t, 1, 4), F.substring(t, 6, 2), F.substring(t, 9, 2))))
            return F.when(day.isNull(), value).otherwise(iso)

        return let(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"), moved)

    return let(_digits(value), run)


def _shift(key: str, text: Column, other: Column, turn: Column) -> Column:
    """Every letter or digit of ``text`` moved within its kind by a keyed stream over ``other``."""
    chars = characters(text)

    def moved(c: Column, i: Column) -> Column:
        step = prf(key, F.concat(F.lit("mail"), i.cast("string")), turn, other)
        within = lambda base, size: F.char(F.lit(base) + F.pmod(F.ascii(c) - base + step % size, F.lit(size)))
        return (F.when(c.rlike("^[a-z]$"), within(97, 26)).when(c.rlike("^[A-Z]$"), within(65, 26))
                 .when(c.rlike("^[0-9]$"), within(48, 10)).otherwise(c))

    return F.array_join(F.transform(chars, moved), "")


def mail(key: str, value: Column) -> Column:
    """Everything before the host's last two labels, character by character."""
    keep = F.regexp_extract(value, r"[A-Za-z0-9-]+\.[A-Za-z]{2,}$", 0)

    def run(body: Column) -> Column:
        cut = F.floor(F.char_length(body) / 2).cast("int")
        start = F.struct(F.substring(body, F.lit(1), cut).alias("x"),
                         F.substring(body, cut + 1, F.char_length(body)).alias("y"))

        def turn(s: Column, i: Column) -> Column:
            return F.struct(s["y"].alias("x"), _shift(key, s["x"], s["y"], i).alias("y"))

        return let(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn), lambda s: F.concat(s["x"], s["y"], keep))

    return let(F.substring(value, F.lit(1), F.char_length(value) - F.char_length(keep)), run)


WRITERS = {"mail": mail, "date": date, "ip": ip, "ssn": ssn, "phone": phone, "card": card}


def kind_of(value: Column) -> Column:
    """The first kind whose whole pattern fits."""
    alone = {k: f"^(?:{p})$" for k, p in PATTERNS.items()}
    alone["card"] = alone["card"].replace(r"\3", r"\1").replace(r"\4", r"\2")
    return reduce(lambda c, k: c.when(value.rlike(alone[k]), F.lit(k)), KINDS[1:], F.when(value.rlike(alone["mail"]), F.lit("mail")))


def pseudonym(key: str, kind: Column, value: Column) -> Column:
    """The pseudonym of one found value; what fails validation stays as it is."""
    return reduce(lambda c, k: c.when(kind == k, WRITERS[k](key, value)), KINDS[1:],
                  F.when(kind == KINDS[0], WRITERS[KINDS[0]](key, value)))


def pseudonymised(docs: DataFrame, key: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``[doc_id, text, found]``: the rewritten text and ``array<struct<start, end, kind, pseudonym>>``.

    Offsets are code points of the original text.
    """
    src = pick(docs, doc_id=id_col, original=text_col)
    text = F.col("original")
    schema = "array<struct<start:long,end:long,kind:string,value:string,pseudonym:string>>"

    def replaced(found: Column) -> Column:
        return F.transform(found, lambda m: let(kind_of(m["found"]), lambda k: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), k.alias("kind"), m["found"].alias("value"),
            pseudonym(key, k, m["found"]).alias("pseudonym"))))

    likely = text.rlike("[0-9]") | text.contains("@")
    marked = src.withColumn("all", F.when(likely, let(matches(text, ANY), replaced)).otherwise(F.array().cast(schema)))
    pieces = F.split(text, ANY, -1)
    rebuilt = F.array_join(F.zip_with(pieces, F.col("all"), lambda p, m: F.concat(p, F.coalesce(m["pseudonym"], F.lit("")))), "")
    valid = F.filter("all", lambda m: m["value"] != m["pseudonym"])
    return marked.select("doc_id", F.when(F.size("all") > 0, rebuilt).otherwise(text).alias("text"),
                         F.transform(valid, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["kind"].alias("kind"),
                                                              m["pseudonym"].alias("pseudonym"))).alias("found"))
