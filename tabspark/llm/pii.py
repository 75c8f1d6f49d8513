"""Format-preserving pseudonyms for personal numbers and dates.

Found values are validated (Luhn for cards, octets for addresses, issued ranges
for social security numbers, real calendar days for dates) and replaced by a
keyed permutation of their format: a Feistel network whose two halves are
shifted in turn by an MD5 of the key, the round and the other half.  Each
format is a domain of its own, so the map is one-to-one: equal values stay
linked across documents, different ones stay different, and a pseudonym passes
the same validation as its original.

Kinds: email (letters and digits of the local part), ipv4, card (13 to 19
digits, last one the Luhn digit), ssn, phone (North American; the first digit of an area
or exchange code stays in 2 to 9, or as it is if not) and date (yyyy-mm-dd, yyyy/mm/dd, mm/dd/yyyy,
dd.mm.yyyy, also d/m/yyyy without zeros; days are permuted in blocks of 72,960 days).  A date with
slashes that is none as mm/dd is read as dd/mm.  A calendar day has one pseudonym in all formats:
days above the 12th and the others are permuted among themselves, so a printed order stays readable.

Cards are looked for at every digit group of a run of digits, spaces and
hyphens and taken, from the left, where the Luhn digit holds: an unseparated
number, or groups of 4-4-4-4, 4-6-5, 4-6-4, 4-4-4-n and 4-4-4-4-n (n of 1 to 3
digits) with one kind of separator, whatever numbers stand beside them.  Other
groupings count where they are a run of their own.

Scale: projections of built-in functions; nothing is shuffled, the JVM's
linear scan of a text finds all kinds at once (every alternative starts behind
a character that can't belong to it), only texts with a long run of digits are
scanned for cards before, and networks run on matches alone.

Defined results: a null text stays null with nothing found; values that don't
validate stay.  Repeated rows get equal results, other columns stay, and an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ["email", "ipv4", "card", "ssn", "phone", "date"]
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
RUN = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}+"
# cards at a digit group, one of whose shapes at most fits; LONG goes on where a group of four may end one of them
SHAPE = r"[0-9]{13,19}|[0-9]{4}([ -])(?:[0-9]{4}\2[0-9]{4}\2(?!TAKEN)[0-9]{1,4}|[0-9]{6}\2(?!TAKEN)[0-9]{4,5})"
LONG = r"[0-9]{4}([ -])(?:[0-9]{4}\2){3}(?!TAKEN)[0-9]{1,3}"
# digit groups behind a letter that says how many groups make up a card found there (a: none)
MARKS = {1: "b", 3: "d", 4: "e", 5: "f"}
MARKED = "|".join(f"{x}[0-9]+(?:[ -][a-f][0-9]+){{{n - 1}}}" for n, x in MARKS.items())
OPEN, CLOSE, LITERAL = "\ufdd0", "\ufdd1", "\ufdd2"  # around a card; after an OPEN of the text
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = (r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])"
         r"[0-9]{3}[ .-][0-9]{4}(?![0-9])")
DATE = (r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])|(?<![0-9/])[0-9]{4}/[0-9]{2}/[0-9]{2}(?![0-9/])"
        r"|(?<![0-9/])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?![0-9/])"
        r"|(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9]|\.[0-9])")
# a run of its own in which no other kind begins; more groups than a card has digits are no card
CARD = (rf"(?<![0-9])(?<![0-9][ -])(?!(?:[0-9]{{1,19}}[ -]){{1,18}}(?:{IPV4}|{SSN}|{PHONE}|{DATE}|{OPEN}))"
        r"[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])")
FOUND = f"{OPEN}[0-9][0-9 -]*{CLOSE}"
ANY = "|".join([FOUND, EMAIL, IPV4, SSN, PHONE, DATE, CARD])
BEFORE = "|".join([EMAIL, IPV4, SSN, PHONE, DATE, RUN])
# a card's last group isn't the first one of these, or of a date or expiry with slashes or dots
TAKEN = rf"[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![0-9-])|[0-9]{{3}}[ -][0-9]{{3}}[ -][0-9]{{4}}(?![0-9])|[0-9]{{1,2}}[/.][0-9]|{DATE}"
FIRST, LETTERS = "0123456789", "!#ABCDEFGH"
BLOCK_L, BLOCK_R = 256, 285  # 72,960 days
WALK = 256
SERIALS = 9999


def _prf(key: str, tag: str, *parts: Column) -> Column:
    """28 bits of an MD5 of the key, the format and the parts."""
    text = F.concat_ws("|", F.lit(key), F.lit(tag), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long")


def feistel_chars(value: Column, key: str, tag: str, capitals: int = 26) -> Column:
    """Permutes the digits and letters of a string, each within its class; other characters stay."""
    def shifted(a: Column, b: Column, r: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            move = _prf(key, tag, r, i, b)
            def turn(base: int, radix: int) -> Column:
                return F.char(F.lit(base) + F.pmod(F.ascii(c) - base + move, F.lit(radix)))
            return (F.when(c.between("0", "9") & (F.length(c) == 1), turn(48, 10))
                    .when(c.between("a", "z") & (F.length(c) == 1), turn(97, 26))
                    .when(c.between("A", chr(64 + capitals)) & (F.length(c) == 1), turn(65, capitals)).otherwise(c))
        return F.array_join(F.transform(F.split(a, ""), one), "")

    def step(s: Column, r: Column) -> Column:
        half = F.floor(F.length(s) / 2).cast("int")
        left, right = F.substr(s, F.lit(1), half), F.substr(s, half + 1)
        return F.when(r % 2 == 0, F.concat(shifted(left, right, r), right)).otherwise(F.concat(left, shifted(right, left, r)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), value, step)


def feistel_pair(left: Column, right: Column, m_left: int, m_right: int, key: str, tag: str, salt: Column | None = None) -> Column:
    """Permutes a pair of numbers below m_left and m_right; a struct of l and r."""
    extra = [] if salt is None else [salt]

    def step(s: Column, r: Column) -> Column:
        a, b = s["l"], s["r"]
        return F.when(r % 2 == 0, F.struct(((a + _prf(key, tag, r, b, *extra)) % m_left).alias("l"), b.alias("r"))).otherwise(
            F.struct(a.alias("l"), ((b + _prf(key, tag, r, a, *extra)) % m_right).alias("r")))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _email(m: Column, key: str) -> Column:
    at = F.instr(m, F.lit("@"))
    return F.concat(feistel_chars(F.substr(m, F.lit(1), at - 1), key, "email"), F.substr(m, at))


def _octets(m: Column) -> Column:
    return F.transform(F.split(m, r"\."), lambda x: x.cast("long"))


def _ipv4(m: Column, key: str) -> Column:
    o = _octets(m)
    p = feistel_pair(F.get(o, 0) * 256 + F.get(o, 1), F.get(o, 2) * 256 + F.get(o, 3), 65536, 65536, key, "ipv4")
    return _with(p, lambda s: F.concat_ws(".", *[x.cast("string") for x in (
        F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256)]))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    return (m != "") & F.call_function("luhn_check", _digits(m))


def _run_cards(run: Column) -> Column:
    """A run of digits (and what follows its last group) with its cards between OPEN and CLOSE."""
    at_groups = lambda shape: F.regexp_extract_all(run, F.lit(
        rf"(?<![0-9])(?=({shape.replace('TAKEN', TAKEN)})(?![0-9])|)[0-9]+"), F.lit(1))
    groups = F.arrays_zip(F.regexp_extract_all(run, F.lit("[0-9]+[^0-9]*"), F.lit(0)).alias("g"),
                          at_groups(f"(?:{SHAPE})").alias("w"), at_groups(LONG).alias("l"))
    def mark(x: Column) -> Column:
        card = F.when(_luhn(x["w"]), x["w"]).when(_luhn(x["l"]), x["l"])
        n = F.size(F.split(card, "[ -]"))
        return F.coalesce(*[F.when(card.isNotNull() & (n == k), F.lit(c)) for k, c in MARKS.items()], F.lit("a"))
    marked = F.array_join(F.transform(groups, lambda x: F.concat(mark(x), x["g"])), "")
    return F.regexp_replace(F.regexp_replace(marked, f"({MARKED})", f"{OPEN}$1{CLOSE}"), "[a-f]", "")


def mark_cards(text: Column) -> Column:
    """The text with OPEN and CLOSE around the cards of its runs of digits, and LITERAL after any OPEN of its own."""
    own = F.replace(text, F.lit(OPEN), F.lit(OPEN + LITERAL))
    is_run = lambda m: m.rlike(f"^{RUN}(?:[/.][0-9])?$")
    tail = BEFORE + "(?:[/.][0-9])?"  # the run's, as it is the last
    hits = F.transform(F.regexp_extract_all(own, F.lit(tail), F.lit(0)), lambda m: F.when(is_run(m), _run_cards(m)).otherwise(m))
    pieces = F.arrays_zip(F.split(own, tail, -1).alias("a"), hits.alias("b"))
    return F.when(text.rlike(RUN), F.array_join(F.transform(pieces, lambda x: F.concat(x["a"], F.coalesce(x["b"], F.lit("")))), "")).otherwise(own)


def _with(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _refill(m: Column, digits: Column) -> Column:
    """m with its digits replaced in order, so separators stay."""
    def char(c: Column, i: Column) -> Column:
        place = F.length(_digits(F.substr(m, F.lit(1), i + 1)))
        return F.when(c.between("0", "9"), F.substr(digits, place, F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.split(m, ""), char), "")


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    check = lambda b: F.element_at(F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda x: x.cast("string")),
        lambda x: F.call_function("luhn_check", F.concat(b, x))), 1)
    new = _with(feistel_chars(F.substr(d, F.lit(1), F.length(d) - 1), key, "card"), lambda b: F.concat(b, check(b)))
    return _with(new, lambda n: _refill(m, n))


def _ssn_parts(m: Column) -> tuple[Column, Column, Column]:
    return tuple(F.substring(m, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = _ssn_parts(m)
    p = feistel_pair(F.when(area > 666, area - 2).otherwise(area - 1), (group - 1) * SERIALS + serial - 1,
                             898, 99 * SERIALS, key, "ssn")
    def text(s: Column) -> Column:
        place = s["l"] + 1
        return F.concat_ws("-", F.lpad(F.when(place >= 666, place + 1).otherwise(place).cast("string"), 3, "0"),
                           F.lpad((F.floor(s["r"] / SERIALS) + 1).cast("string"), 2, "0"), F.lpad((s["r"] % SERIALS + 1).cast("string"), 4, "0"))
    return _with(p, text)


def _phone(m: Column, key: str) -> Column:
    start = F.length(F.regexp_extract(m, r"^(?:\+?1[ .-]?(?=[(0-9]))?", 0)) + 1  # the country code stays
    own = F.substr(m, start)
    d = _digits(own)
    first = lambda at: F.translate(F.substring(d, at, 1), FIRST, LETTERS)
    marked = F.concat(first(1), F.substring(d, 2, 2), first(4), F.substring(d, 5, 6))
    new = F.translate(feistel_chars(marked, key, "phone", capitals=8), LETTERS, FIRST)
    return F.concat(F.substr(m, F.lit(1), start - 1), _with(new, lambda n: _refill(own, n)))


def _calendar(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")


def _day(m: Column) -> Column:
    """The calendar day of a date in one of the formats, or null."""
    x = [F.get(F.split(m, "[-/.]"), i) for i in range(3)]
    us = F.when(m.contains("/"), _calendar(x[2], x[0], x[1]))
    return F.when(F.length(x[0]) == 4, _calendar(*x)).otherwise(F.coalesce(us, _calendar(x[2], x[1], x[0])))


def _moved_day(day: Column, key: str) -> Column:
    """The day that takes a day's place."""
    size = BLOCK_L * BLOCK_R
    n = F.datediff(day, F.lit("1600-01-01").cast("date")).cast("long")
    block, at = F.floor(n / size), F.pmod(n, F.lit(size))
    p = feistel_pair(F.floor(at / BLOCK_R), at % BLOCK_R, BLOCK_L, BLOCK_R, key, "date", block)
    return F.date_add(F.lit("1600-01-01").cast("date"),
                      (block * size + _with(p, lambda s: s["l"] * BLOCK_R + s["r"])).cast("int"))


def _date(m: Column, key: str) -> Column:
    first = F.get(F.split(m, "[-/.]"), 0)
    # on to the next day on the same side of the 12th, so that dd/mm stays apart from mm/dd and a day
    # has one pseudonym in all formats (within WALK steps but for odds of 1e-55)
    above = lambda d: F.dayofmonth(d) > 12
    walked = _with(_day(m), lambda own: F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), _moved_day(own, key),
                                                    lambda d, _: F.when(above(d) == above(own), d).otherwise(_moved_day(d, key))))
    month, day = F.when(F.length(m) < 10, "M").otherwise("MM"), F.when(F.length(m) < 10, "d").otherwise("dd")
    form = (F.when(m.contains("-"), "yyyy-MM-dd").when(F.length(first) == 4, "yyyy/MM/dd").when(m.contains("."), "dd.MM.yyyy")
            .when(first.cast("int") > 12, F.concat(day, F.lit("/"), month, F.lit("/yyyy"))).otherwise(F.concat(month, F.lit("/"), day, F.lit("/yyyy"))))
    return _with(walked, lambda d: F.call_function("date_format", d, form))


def kind_of(m: Column) -> Column:
    """Kind of a validated match, or null."""
    area, group, serial = _ssn_parts(m)
    whole = lambda p: m.rlike(f"^(?:{p})$")
    year = F.year(_day(m))
    return (F.when(m.startswith(OPEN), F.lit("card"))
            .when(m.contains("@"), F.lit("email"))
            .when(whole(IPV4) & F.forall(_octets(m), lambda o: o <= 255), F.lit("ipv4"))
            .when(whole(SSN), F.when((area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0), F.lit("ssn")))
            .when(whole(PHONE), F.lit("phone"))
            # a date's block has to lie within years of four digits
            .when(whole(DATE) & year.between(1600, 9900), F.lit("date"))
            .when(whole(CARD) & F.call_function("luhn_check", _digits(m)), F.lit("card")))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a match of ANY; values that don't validate stay."""
    kind = kind_of(m)
    return (F.when(kind == "email", _email(m, key)).when(kind == "ipv4", _ipv4(m, key)).when(kind == "card", _card(F.translate(m, OPEN + CLOSE, ""), key))
            .when(kind == "ssn", _ssn(m, key)).when(kind == "phone", _phone(m, key)).when(kind == "date", _date(m, key)).otherwise(m))


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with text freed of personal numbers and dates, plus n_found and found (kind and count)."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_found", "found")]
    marked = docs.select(*keep, mark_cards(F.col("text")).alias("text"))
    hits = F.regexp_extract_all(F.col("text"), F.lit(ANY), F.lit(0))
    each = F.transform(hits, lambda m: F.struct(kind_of(m).alias("kind"), pseudonym(m, key).alias("new")))
    rows = marked.select(*keep, "text", each.alias("__each"))
    pieces = F.arrays_zip(F.split("text", ANY, -1).alias("a"), F.col("__each.new").alias("b"))
    text = F.when(F.size("__each") > 0, F.array_join(F.transform(pieces, lambda x: F.concat(x["a"], F.coalesce(x["b"], F.lit("")))), "")).otherwise(F.col("text"))
    text = F.replace(text, F.lit(OPEN + LITERAL), F.lit(OPEN))
    kinds = F.filter(F.col("__each.kind"), lambda k: k.isNotNull())
    return rows.select(*keep, text.alias("text"), F.coalesce(F.size(kinds), F.lit(0)).cast("long").alias("n_found"), kinds.alias("found"))
