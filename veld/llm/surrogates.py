"""Personal data replaced by surrogates, in DataFrame operations only.

Entities are e-mail addresses, phone numbers (international, and ten digits of North America with
or without separators), IPv4 and IPv6 addresses, payment card numbers (valid by Luhn), IBANs
(valid by their check digits), US social security numbers and names behind a title.  Each gets a
keyed replacement of its own type and format: digits for digits in the same places, check digits
valid, a country's code kept, a private address in its own private range, a name with its title,
a given name of the title's gender (behind Dr or Prof: that of its ending) and a family name,
both in the script (Latin, Greek, Cyrillic) and case of the original.

Coreference: the replacement depends on the key and the normalised value alone (a mail address
without case, its domain by itself; a phone number without +1; an IPv6 address written out; a
name without case, title and the ending of gender), so an entity is replaced alike in all
documents, however it is written.  Distinctness: the replacements of all distinct values are
checked against each other and against all original values; of values that clash, the smallest
keeps its replacement and the others draw again until none clash.  Private IPv4 addresses are
permuted within their range, which is distinct by itself.  Only values that drew again are kept in
a table and joined back to the texts; all others are replaced where they stand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

# Titles by gender (n: either), and syllables by script.
TITLES = {"m": ["Mr", "Herr", "Herrn", "Monsieur", "Señor", "Signor", "господин", "κύριος"],
          "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Signora", "госпожа", "κυρία"],
          "n": ["Dr", "Prof"]}
SYLLABLES = {"latin": "ba be bo ca co da de di do fa fe ga go ha he jo ka ke la le li lo ma me mi mo na ne ni no pa pe "
                      "ra re ri ro sa se si so ta te ti to va ve vi vo za".split(),
             "cyrillic": "ба бе бо ва ве ви во га го да де ди до за зо ка ки ко ла ле ли ло ма ми мо на не ни но па пе "
                         "ра ре ри ро са се си со та те ти то".split(),
             "greek": "βα βε βο γα γε δα δε δι δο θα θε κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο πα πε ρα ρε ρι "
                      "ρο σα σε σι τα τε τι το φα φι".split()}
GIVEN_END = {"latin": {"m": ["n", "r", "s", "l"], "f": ["na", "ra", "lia", "sa"]},
             "cyrillic": {"m": ["н", "р", "м", "л"], "f": ["на", "ра", "лия", "са"]},
             "greek": {"m": ["ς", "ος", "ης", "ων"], "f": ["να", "ρα", "νη", "ία"]}}
# Family endings, and how a feminine one is made of a masculine one.
FAMILY_END = {"latin": ["son", "ner", "man", "ley"], "cyrillic": ["ов", "ин", "ев"], "greek": ["όπουλος", "άκης", "ίδης"]}
FEMININE = [("(ов|ев|ёв|ин|ын)$", "$1а", "(ов|ев|ёв|ин|ын)а$", "$1"), ("ский$", "ская", "ская$", "ский"),
            ("όπουλος$", "οπούλου", "οπούλου$", "όπουλος"), ("άκης$", "άκη", "άκη$", "άκης"), ("ίδης$", "ίδου", "ίδου$", "ίδης")]
# Lengths of IBANs, and the calling codes of two digits (1 and 7 have one, others three).
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
                22: "BG BH CR DE GB GE IE ME RS", 23: "AE GI IL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT", 26: "IS TR",
                27: "FR GR IT MC SM", 28: "AL AZ CY DO GT HU LB PL", 29: "BR PS QA", 30: "KW MU", 31: "MT"}
TWO_DIGIT_CODES = ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
                   "90 91 92 93 94 95 98").split()
#: Private, loopback and link-local IPv4 ranges: pattern and number of free bits.
PRIVATE = [(r"^10\.", 24), (r"^127\.", 24), (r"^172\.(1[6-9]|2\d|3[01])\.", 20), (r"^192\.168\.", 16), (r"^169\.254\.", 16)]

ENDS = {f"given:{gender}:{script}": ends for script, by_gender in GIVEN_END.items() for gender, ends in by_gender.items()} \
    | {f"family:{script}": ends for script, ends in FAMILY_END.items()}


def _title_forms() -> tuple[list[str], list[str]]:
    """Titles as written with or without a point: as listed, with a capital, in capitals, in small
    letters; and those with a point only, which are other words without one ("MS", "ms")."""
    free = {f for ts in TITLES.values() for t in ts for f in (t, t[0].upper() + t[1:], t.upper(), t.lower())}
    pointed = {"MS", "ms"}
    longest = lambda forms: sorted(forms, key=lambda t: (-len(t), t))
    return longest(free - pointed - {"miss"}), longest(pointed)


_FREE, _POINTED = _title_forms()
_TITLE = rf"(?:(?:{'|'.join(_FREE)})\.?|(?:{'|'.join(_POINTED)})\.)"
#: Where a title starts: no letter before it, and one of the titles' first letters there.
_START = rf"(?<!\p{{L}})(?=[{''.join(sorted({t[0] for t in _FREE + _POINTED}))}])"
_WORD = r"\p{Lu}[\p{L}'’-]*\p{L}"
_HEX = r"[0-9A-Fa-f]{1,4}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IBAN = "|".join(rf"(?:{'|'.join(codes.split())})\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in sorted(IBAN_LENGTHS.items(), reverse=True))
#: What an entity looks like; starts are fixed by look-behind, so a long run is tried once.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}(?![A-Za-z0-9-])",
    "iban": rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])",
    "ip6": rf"(?<![\w:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[0-9A-Fa-f:]*[0-9])(?:{_HEX}(?::{_HEX}){{0,5}})?::{_HEX}(?::{_HEX}){{0,5}})(?![\w:]|\.\d)",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ssn": r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])",
    "phone": r"(?<![\w+])\+1[ .-]?(?:\(\d{3}\)[ .-]?|\d{3}[ .-]?)\d{3}[ .-]?\d{4}(?!\d)"
             r"|(?<![\w+])\+(?:[02-9]|1(?=\d{11}))\d*(?:(?: ?\(\d{1,4}\) ?|[ .-])?\d){7,13}(?!\d)"
             r"|(?<![\w+])(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
             r"|(?<![\w.+-])[2-9]\d{2}[2-9]\d{6}(?![\w-]|\.\d)",
    "card": r"(?<![\w-])(?:(?:\d{4} ){3}\d{4}|(?:\d{4}-){3}\d{4}|(?:\d[ -]?){12,18}\d)(?![\w-])",
    "name": rf"{_START}{_TITLE} {_WORD}(?: {_WORD})?(?!\p{{L}})"}
ENTITY = "|".join(PATTERNS.values())
KINDS = tuple(PATTERNS)
#: What every entity but a mail address has: a digit and a point (IPv4), three digits with at most
#: a space or hyphen after each (numbers), a plus and a digit, two colons or a row of groups (IPv6), two
#: letters and two digits (IBAN), or a title and a capital letter (name).
MARKS = (r"[0-9][ -]?[0-9][ -]?[0-9]|[0-9][.]|\+[0-9]|::|:[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:|[A-Z]{2}[0-9]{2} ?[A-Z0-9]",
         rf"{_START}{_TITLE} \p{{Lu}}")
_US = "\x1f"


def _kind(m: Column) -> Column:
    """The type of an entity, from its form alone; ``none`` for numbers whose check digits fail."""
    phone = m.startswith("+") | m.startswith("(") | (F.length(_digits(m)) == 10)
    return F.when(m.contains("@"), "email").when(m.contains(":"), "ip6") \
        .when(m.rlike(r"^[A-Z]{2}\d{2}"), F.when(_mod97(_packed(m)) == 1, "iban").otherwise("none")).when(m.rlike(r"^\p{L}"), "name") \
        .when(m.rlike(r"^\d+(\.\d+){3}$"), "ip").when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(phone, "phone") \
        .when(luhn_sum(_digits(m), True) % 10 == 0, "card").otherwise("none")


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _packed(m: Column) -> Column:
    return F.replace(m, F.lit(" "), F.lit(""))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def _mod97(iban: Column) -> Column:
    """The number that an IBAN stands for (its first four characters last, letters as 10 to 35), modulo 97."""
    chars = F.split(F.concat(F.substring(iban, 5, 100), F.substring(iban, 1, 4)), "")
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0), lambda a, c: (
        a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)


def masculine(word: Column) -> Column:
    for _, _, ending, made in FEMININE:
        word = F.regexp_replace(word, ending, made)
    return word


def feminine(word: Column) -> Column:
    for ending, made, _, _ in FEMININE:
        word = F.regexp_replace(word, ending, made)
    return word


def _gender(title: Column) -> Column:
    plain = F.lower(F.regexp_replace(title, r"\.$", ""))
    return F.when(plain.isin([t.lower() for t in TITLES["m"]]), "m").when(plain.isin([t.lower() for t in TITLES["f"]]), "f").otherwise("n")


def _ip6_groups(m: Column) -> Column:
    """The eight groups of an IPv6 address, in small letters and without leading zeros."""
    groups = lambda part: F.filter(F.split(part, ":"), lambda g: g != "")
    low = F.lower(m)
    head = groups(F.substring_index(low, "::", 1))
    tail = F.when(low.contains("::"), groups(F.substring_index(low, "::", -1))).otherwise(F.array().cast("array<string>"))
    zeros = F.array_repeat(F.lit("0"), F.lit(8) - F.size(head) - F.size(tail))
    return F.transform(F.concat(head, zeros, tail), lambda g: F.regexp_replace(g, "^0+(?=.)", ""))


def parts(m: Column, kind: Column) -> Column:
    """The parts of an entity that are replaced: an array of (type, normalised value).  A mail address
    has itself and its domain; a name its family name and, if there are two words behind the
    title, its given name."""
    part = lambda type_, value: F.struct(type_.alias("type"), value.alias("value"))

    def of_name(words: Column) -> Column:
        family = F.lower(F.element_at(words, -1))
        given = F.lower(F.get(words, F.lit(1)))
        title = _gender(F.get(words, F.lit(0)))
        gender = F.when(title != "n", title).when(given.rlike("[aаαηάή]$"), "f").otherwise("m")
        family = part(F.concat(F.lit("family:"), _script(family)), masculine(family))
        return F.when(F.size(words) > 2, F.array(family, part(F.concat_ws(":", F.lit("given"), gender, _script(given)), given))) \
            .otherwise(F.array(family))

    def of_phone(digits: Column) -> Column:
        home = (F.length(digits) == 11) & digits.startswith("1")
        return F.when(home, F.substring(digits, 2, 10)).when(m.startswith("+"), F.concat(F.lit("+"), digits)).otherwise(digits)

    low = F.lower(m)
    private = F.lit(False)
    for pattern, _ in PRIVATE:
        private = private | m.rlike(pattern)
    one = F.when(kind == "ip", part(F.when(private, "private").otherwise("ip"), m)) \
        .when(kind == "ip6", part(kind, F.array_join(_ip6_groups(m), ":"))).when(kind == "iban", part(kind, _packed(m))) \
        .when(kind == "phone", part(kind, _let(_digits(m), of_phone))).otherwise(part(kind, _digits(m)))
    return F.when(kind == "name", _let(F.split(m, " "), of_name)) \
        .when(kind == "email", F.array(part(F.lit("mailbox"), low), part(F.lit("domain"), F.substring_index(low, "@", -1)))) \
        .when(kind == "none", F.array().cast("array<struct<type:string,value:string>>")).otherwise(F.array(one))


def luhn_sum(digits: Column, last_is_check: bool) -> Column:
    """The Luhn sum of a string of digits; without its check digit, as if one followed."""
    odd = F.lit(0 if last_is_check else 1)
    chars = F.reverse(F.split(digits, ""))
    each = F.transform(F.filter(chars, lambda c: c != ""), lambda c, i: F.when(
        (i + odd) % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _lists(by_type: dict[str, list[str]]) -> Column:
    return F.create_map(*[c for k, v in by_type.items() for c in (F.lit(k), F.array(*map(F.lit, v)))])


def permuted_private(address: Column, key: str) -> Column:
    """A private IPv4 address permuted within its range: four Feistel rounds on its free bits."""
    size = F.lit(0)                                   # two to the half of the free bits
    for pattern, bits in reversed(PRIVATE):
        size = F.when(address.rlike(pattern), F.lit(2 ** (bits // 2))).otherwise(size)
    quotient = lambda x, by: F.floor(x / by).cast("long")
    number = F.aggregate(F.split(address, r"\."), F.lit(0).cast("long"), lambda a, o: a * 256 + o.cast("long"))

    def moved(v: Column) -> Column:
        n, size = v["n"], v["size"]
        host = n % (size * size)
        start = F.struct(quotient(host, size).alias("l"), (host % size).alias("r"))
        turn = lambda a, i: F.struct(a["r"].alias("l"), ((a["l"] + F.pmod(F.xxhash64(F.lit(key), i, a["r"]), size)) % size).alias("r"))
        ends = F.aggregate(F.sequence(F.lit(1), F.lit(4)), start, turn)
        return _let(ends, lambda e: n - host + e["l"] * size + e["r"])

    made = _let(F.struct(number.alias("n"), size.cast("long").alias("size")), moved)
    return _let(made, lambda n: F.concat_ws(".", *[(quotient(n, F.lit(256 ** k)) % 256).cast("string") for k in (3, 2, 1, 0)]))


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The replacement of a normalised value at its n-th draw."""

    def drawn(seed: Column) -> Column:
        draw = lambda i, n: F.pmod(F.xxhash64(seed, i), n).cast("int")
        digit = lambda i: draw(i, F.lit(10)).cast("string")
        letter = lambda i: F.char(F.lit(97) + draw(i, F.lit(26)))
        each = lambda text, use: F.array_join(F.transform(F.split(text, ""), use), "")
        over = lambda low, high, use: F.array_join(F.transform(F.sequence(low, high), use), "")
        choose = lambda options, i: F.element_at(options, draw(i, F.size(options)) + 1)
        between = lambda i, low, n: (draw(i, F.lit(n)) + low)
        padded = lambda i, low, n, width: F.lpad(between(i, low, n).cast("string"), width, "0")
        length = F.length(value)
        # a mailbox is told apart within its domain; it and a domain have one more letter with each draw
        mailbox = F.concat(
            each(F.substring_index(value, "@", 1), lambda c, i: F.when(c.rlike("[0-9]"), digit(i)).when(
                c.rlike("[a-z]"), letter(i)).otherwise(c)),
            F.when(attempt > 0, over(F.lit(401), F.lit(400) + attempt, letter)).otherwise(""),
            F.lit("@"), F.substring_index(value, "@", -1))
        domain = F.concat(over(F.lit(100), F.lit(105) + attempt, letter), F.lit(".example."), F.substring_index(value, ".", -1))
        ip = F.concat_ws(".", between(F.lit(1), 11, 89).cast("string"), over_dots(draw))
        hexes = lambda i, low, n: F.lower(F.hex(between(i, low, n)))
        first = lambda c: F.when(c.rlike("^fe[89ab].$"), c).when(c.rlike("^f[cd]..$"), F.concat(F.lit("fd"), F.lpad(
            hexes(F.lit(0), 0, 256), 2, "0"))).otherwise(F.concat(F.lit("2"), F.lpad(hexes(F.lit(0), 0, 4096), 3, "0")))
        ip6 = F.array_join(F.transform(F.split(value, ":"), lambda c, i: F.when((c == "0") & (attempt == 0), c).when(
            i == 0, first(c)).otherwise(hexes(i, 1, 65535))), ":")
        national = each(value, lambda c, i: F.when((i == 0) | (i == 3), between(i, 2, 8).cast("string")).otherwise(digit(i)))
        code = F.when(F.substring(value, 2, 1).isin("1", "7"), 1).when(F.substring(value, 2, 2).isin(TWO_DIGIT_CODES), 2).otherwise(3)
        abroad = each(value, lambda c, i: F.when(i <= code, c).when((i == code + 1) & (c != "0"), between(i, 1, 9).cast("string"))
                      .when(i == code + 1, c).otherwise(digit(i)))
        body = each(value, lambda c, i: F.when(i == 0, c).when(i < length - 1, digit(i)).otherwise(""))
        check = F.pmod(F.lit(10) - luhn_sum(body, False) % 10, F.lit(10)).cast("string")
        account = each(F.substring(value, 5, 100), lambda c, i: F.when(c.rlike("[0-9]"), digit(i)).otherwise(F.upper(letter(i))))
        iban = _let(account, lambda a: F.concat(F.substring(value, 1, 2), F.lpad((F.lit(98) - _mod97(F.concat(
            F.substring(value, 1, 2), F.lit("00"), a))).cast("string"), 2, "0"), a))
        ssn = F.concat(padded(F.lit(1), 100, 565, 3), padded(F.lit(2), 1, 99, 2), padded(F.lit(3), 1, 9999, 4))
        # a name has two syllables and one more for every eight draws, so there are always enough
        syllables = F.element_at(_lists(SYLLABLES), F.substring_index(kind, ":", -1))
        ends = F.element_at(_lists(ENDS), kind)
        name = F.concat(over(F.lit(1), F.lit(2) + F.floor(attempt / 8).cast("int"), lambda i: choose(syllables, i)), choose(ends, F.lit(300)))
        return F.when(kind == "mailbox", mailbox).when(kind == "domain", domain).when(kind == "ip", ip) \
            .when(kind == "private", permuted_private(value, key)).when(kind == "ip6", ip6) \
            .when(kind == "phone", F.when(value.startswith("+"), abroad).otherwise(national)) \
            .when(kind == "card", F.concat(body, check)).when(kind == "iban", iban).when(kind == "ssn", ssn).otherwise(name)

    def over_dots(draw) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(2), F.lit(4)), lambda i: (draw(i, F.lit(254)) + 1).cast("string")), ".")

    return _let(F.sha2(F.concat_ws(_US, F.lit(key), kind, value, attempt.cast("string")), 256), drawn)


def _dressed(m: Column, kind: Column, made: Column) -> Column:
    """The surrogates of an entity's parts in its own format; ``m`` itself where it is no entity."""
    first = F.get(made, F.lit(0))
    # characters go where characters were, from the last to the first: a country's code may be left over
    slot = lambda c: c.between("0", "9") | ((kind == "iban") & c.between("A", "Z"))
    chars = F.split(m, "")
    number = _let(F.when(kind == "iban", first).otherwise(_digits(first)), lambda new: _let(
        F.transform(chars, slot), lambda taken: F.array_join(F.transform(chars, lambda c, i: _let(
            F.length(new) - F.size(F.filter(F.slice(taken, i + 1, F.length(m)), lambda t: t)) + 1,
            lambda at: F.when(slot(c) & (at > 0), F.substring(new, at, F.lit(1))).otherwise(c))), "")))

    def ip6(groups: Column) -> Column:
        size = lambda part: F.size(F.filter(F.split(part, ":"), lambda g: g != ""))
        head, tail = size(F.substring_index(m, "::", 1)), size(F.substring_index(m, "::", -1))
        gap = F.slice(groups, head + 1, F.lit(8) - head - tail)
        short = m.contains("::") & ~F.exists(gap, lambda g: g != "0")
        text = F.when(short, F.concat(F.array_join(F.slice(groups, F.lit(1), head), ":"), F.lit("::"),
                                      F.array_join(F.slice(groups, F.lit(9) - tail, tail), ":"))).otherwise(F.array_join(groups, ":"))
        return F.when(m.rlike("[A-F]") & (m == F.upper(m)), F.upper(text)).otherwise(text)

    def name(words: Column) -> Column:
        title, old = F.get(words, F.lit(0)), F.element_at(words, -1)
        woman = (_gender(title) == "f") | (masculine(F.lower(old)) != F.lower(old))
        family = F.when(woman, feminine(first)).otherwise(first)
        cased = lambda was, new: F.when(was == F.upper(was), F.upper(new)).otherwise(F.initcap(new))
        given = F.when(F.size(made) > 1, F.concat(F.lit(" "), cased(F.get(words, F.lit(1)), F.get(made, F.lit(1))))).otherwise("")
        return F.concat(title, given, F.lit(" "), cased(old, family))

    email = F.concat(F.substring_index(first, "@", 1), F.lit("@"), F.get(made, F.lit(1)))
    return F.when(kind == "none", m).when(kind == "name", _let(F.split(m, " "), name)).when(kind == "email", email) \
        .when(kind == "ip", first).when(kind == "ip6", _let(F.split(first, ":"), ip6)).otherwise(number)


def draws(values: DataFrame, key: str) -> DataFrame:
    """``type``, ``value`` and ``attempt`` of the values (distinct ``type``, ``value``) whose first
    replacement clashed.  Ends, as every draw is new and names grow."""
    family = F.substring_index("type", ":", 1)       # names of all genders and scripts are told apart
    values = written(values.filter("type != 'private'").withColumn("family", family), "entities")
    pending = values.withColumn("attempt", F.lit(0))
    taken, settled, tries = [], [], 0
    while True:
        drawn = pending.withColumn("surrogate", surrogate(F.col("type"), F.col("value"), F.col("attempt"), key))
        first = drawn.groupBy("family", "surrogate").agg(F.min(F.struct("type", "value")).alias("winner"), F.count(F.lit(1)).alias("n"))
        drawn = drawn.join(first.hint("merge"), ["family", "surrogate"]) if tries else drawn.join(first.filter("n > 1").hint("merge"), ["family", "surrogate"], "left")
        original = values.select("family", F.col("value").alias("surrogate")).distinct().withColumn("original", F.lit(True))
        drawn = drawn.join(original.hint("merge"), ["family", "surrogate"], "left")
        clash = F.col("original").isNotNull() | F.coalesce(F.col("winner") != F.struct("type", "value"), F.lit(False))
        if taken:
            used = reduce(DataFrame.union, taken).withColumn("used", F.lit(True))
            drawn = drawn.join(used.hint("merge"), ["family", "surrogate"], "left")
            clash = clash | F.col("used").isNotNull()
        drawn = written(drawn.select("family", "type", "value", "attempt", "surrogate", clash.alias("clash")), "draws")
        taken.append(drawn.filter("not clash").select("family", "surrogate"))
        if tries:
            settled.append(drawn.filter("not clash").select("type", "value", "attempt"))
        pending = drawn.filter("clash").select("type", "value", "family", (F.col("attempt") + 1).alias("attempt"))
        tries += 1
        if pending.isEmpty():
            break
    none = values.filter("false").select("type", "value", F.lit(0).alias("attempt"))
    return reduce(DataFrame.union, settled, none)


def perhaps(t: Column) -> Column:
    """Whether a text may have an entity: true for all that ``ENTITY`` is found in, and cheaper."""
    return t.contains("@") | t.rlike(MARKS[0]) | t.rlike(MARKS[1])


def _free(name: str, taken: list[str]) -> str:
    """``name``, or with the first number that no column has."""
    low = {c.lower() for c in taken}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(1, len(taken) + 2))) if n.lower() not in low)


#: Parts that the hits of one redrawn value are spread over before they are joined.
SALT = 16


def replace_entities(docs: DataFrame, key: str, text: str = "text", counts: str | None = "entities") -> DataFrame:
    """``docs`` with ``text`` replaced, and a struct column ``counts`` added (``entities_1`` and so on
    where ``docs`` has one of that name; none if None) of ``n_email``, ``n_iban``, ``n_ip6``, ``n_ip``, ``n_ssn``,
    ``n_phone``, ``n_card``, ``n_name`` (long); every other column and row as it is.

    A null text stays null and an empty one empty.  Rows with equal texts are replaced alike.  An
    empty table gives an empty one."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = F.when(perhaps(t), F.regexp_extract_all(t, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    found = F.transform(found, lambda m: F.struct(m.alias("m"), _kind(m).alias("kind")))
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), found.alias("found"))
    some = F.size("found") > 0
    name = F.sha2("text", 256)                       # of the text, for its list of redrawn values
    hits = rows.filter(some).select(name.alias("h"), F.explode("found").alias("e")).distinct()
    hits = written(hits.select("h", F.explode(parts(F.col("e.m"), F.col("e.kind"))).alias("part"))
                   .select("h", "part.type", "part.value"), "entity-hits")
    again = written(draws(hits.select("type", "value").distinct(), key), "entity-draws")
    spread = again.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    redrawn = hits.withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(SALT))).join(spread.hint("merge"), ["type", "value", "salt"])
    redrawn = written(redrawn.groupBy("h").agg(F.map_from_entries(F.collect_set(
        F.struct(F.concat_ws(_US, "type", "value"), "attempt"))).alias("draws")), "text-draws")
    joined = rows.join(redrawn, F.when(some, name) == F.col("h"), "left")
    attempt = lambda p: F.coalesce(F.try_element_at("draws", F.concat_ws(_US, p["type"], p["value"])), F.lit(0))
    made = lambda e: F.transform(parts(e["m"], e["kind"]), lambda p: _let(
        attempt(p), lambda a: surrogate(p["type"], p["value"], a, key)))
    new = F.transform("found", lambda e: _let(made(e), lambda x: _dressed(e["m"], e["kind"], x)))
    whole = F.array_join(F.flatten(F.zip_with(F.split("text", ENTITY, -1), new, lambda gap, n: F.array(
        gap, F.coalesce(n, F.lit(""))))), "")
    count = lambda kind: F.size(F.filter("found", lambda e: e["kind"] == kind)).cast("long").alias(f"n_{kind}")
    out = [F.when(some, whole).otherwise(F.col("text")).alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    if counts is not None:
        out.append(F.struct(*[count(k) for k in KINDS]).alias(_free(counts, docs.columns)))
    return joined.select(*out)
