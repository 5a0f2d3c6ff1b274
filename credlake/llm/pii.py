r"""Personal data: keyed, type-consistent surrogates, by DataFrame expressions only.

One pattern finds e-mail addresses, secrets (long hexadecimal strings and
common key formats), IBANs, card-like numbers, phone numbers, social security
numbers, IP addresses and names after a title.  Every distinct entity (kind
and normalised value) of the corpus gets one surrogate, drawn from
SHA-256(key, kind, value, attempt):

* coreference: equal values, in any spelling of their format, get equal
  surrogates in all documents;
* distinctness: a candidate that another entity also drew, that is taken, or
  that is itself a real value of the corpus is refused (the smallest value
  keeps a shared one) and drawn anew with the next attempt, until all differ;
* format: an occurrence keeps its separators, its letter case (all upper or
  not), lengths of numbers and secrets, country prefixes, the leading digit
  and the Luhn digit of cards, IBAN countries; addresses move to reserved
  space (240.0.0.0/4, fd00::/8, example.org, area numbers from 900);
* a number without a card's check digit is no card and stays; surrogates of
  cards and IBANs have right check digits; secrets differ by letter case;
* names: the title stays; a given name gets a name of the title's gender, all
  names one of the same script (Latin, Cyrillic or Greek) and capitalisation.

Entities are joined with their surrogates row by row, so a value that a third
of the documents hold is a skewed join that Spark splits; texts are shuffled
only where they hold an entity, once per distinct text in the entity table.

Defined results: null and empty texts stay as they are, as does any text
without an entity, byte for byte.  Repeated rows get equal texts.  An empty
table gives an empty result.  The pattern's runs are possessive and anchored
at run starts, so a very long run of letters or digits takes linear time.
Other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlake.llm.common import fresh, stored

# Titles by gender.
MALE = "Mr Mister Sir Herr Monsieur Señor Sr Don Signor Г-н Господин Κύριος Κ".split()
FEMALE = "Mrs Ms Miss Madam Frau Madame Mme Mademoiselle Señora Sra Señorita Doña Signora Г-жа Госпожа Κυρία".split()
# Letters for made-up names by script, consonants and vowels.
SYLLABLES = {"latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу"), "greek": ("βγδζκλμνπρστ", "αειου")}
ENDINGS = {"latin": ("n", "a", "r"), "cyrillic": ("н", "а", "в"), "greek": ("ς", "α", "ν")}

EDGE, END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
TITLE = "(?:" + "|".join(MALE + FEMALE) + r")\.?"
NAME = r"\p{Lu}[\p{L}'’-]++"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "secret": rf"{EDGE}(?:(?=[A-Fa-f]*+\d)[0-9A-Fa-f]{{32,}}+|AKIA[0-9A-Z]{{16}}|gh[pousr]_[0-9A-Za-z]{{36,}}+|sk[-_][0-9A-Za-z_-]{{20,}}+){END}",
    "iban": rf"{EDGE}[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?{END}",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:])(?=[A-Fa-f:]*+\d)(?:[0-9A-Fa-f]{{1,4}}:){{3,7}}(?::?[0-9A-Fa-f]{{1,4}}){END}",
    "ip": r"(?<![\p{L}\p{N}.])(?:\d{1,3}\.){3}\d{1,3}(?![\p{L}\p{N}]|\.\d)",
    "ssn": rf"(?<![\p{{L}}\p{{N}}-])\d{{3}}-\d{{2}}-\d{{4}}(?![\p{{L}}\p{{N}}-])",
    "card": r"(?<![\p{L}\p{N}+.-])(?:\d{13,19}+|\d{4}(?: \d{4}){2} \d{1,7}|\d{4}(?:-\d{4}){2}-\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
             r"|\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\p{L}\p{N}])",
    "name": rf"{EDGE}{TITLE} {NAME}(?: {NAME}){{0,2}}",
}
# What every match holds, cheap to look for: a digit, an at sign, a title or a key prefix.
GATE = rf"[0-9@]|{EDGE}{TITLE} \p{{Lu}}|{EDGE}(?:AKIA|gh[pousr]_|sk[-_])"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
MAX_ATTEMPTS = 64


def matches(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def kind_of(found: Column) -> Column:
    """The first pattern, in the order of the alternation, that the whole match fits."""
    out = F.lit("name")
    for kind in reversed([k for k in PATTERNS if k != "name"]):
        body = PATTERNS[kind]
        out = F.when(found.rlike(f"^(?:{body})$"), F.lit(kind)).otherwise(out)
    return out


def normal(kind: Column, token: Column) -> Column:
    """What equal entities share: digits, or lower-case letters and digits; a secret is its own value, unless it is a hexadecimal number."""
    digits = F.regexp_replace(token, r"\D", "")
    phone = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)
    return (F.when(kind == "phone", phone).when(kind.isin("card", "ssn"), digits)
            .when(kind == "iban", F.upper(F.regexp_replace(token, " ", ""))).when((kind == "ip") | ((kind == "secret") & ~token.rlike("^[0-9A-Fa-f]+$")), token).otherwise(F.lower(token)))


def real(kind: Column, token: Column) -> Column:
    """Whether a number that looks like a card has a card's check digit; True for other kinds (a mistyped IBAN is still one)."""
    return F.when(kind == "card", F.pmod(_luhn_sum(normal(kind, token), 0), F.lit(10)) == 0).otherwise(True)


def _mod97(text: Column) -> Column:
    """The remainder of ISO 13616: digits as they are, letters as 10 to 35."""
    def step(rest: Column, c: Column) -> Column:
        return F.pmod(F.when(c.rlike("[0-9]"), rest * 10 + c.try_cast("int")).otherwise(rest * 100 + F.ascii(c) - 55), F.lit(97))
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def occurrences(rows: DataFrame, text: str, key: str) -> DataFrame:
    """(key, at, part, kind, token, value) per entity part of every distinct text; names have a part per word, titles no kind."""
    found = rows.select(F.col(key).alias("key"), F.posexplode(matches(F.col(text))).alias("at", "found")).distinct()
    typed = found.withColumn("kind", kind_of(F.col("found")))
    typed = typed.withColumn("kind", F.when(real(F.col("kind"), F.col("found")), F.col("kind")).otherwise(F.lit("none")))
    words = F.split("found", " ")
    parts = typed.select("key", "at", "kind", "found", F.size(words).alias("n"),
                         F.posexplode(F.when(F.col("kind") == "name", words).otherwise(F.array("found"))).alias("part", "token"))
    woman = F.col("found").rlike("^(?:" + "|".join(FEMALE) + r")\.? ")
    given = (F.col("n") > 2) & (F.col("part") < F.col("n") - 1)
    kind = (F.when(F.col("kind") == "none", F.lit(None)).when(F.col("kind") != "name", F.col("kind")).when(F.col("part") == 0, F.lit(None))
            .when(given, F.when(woman, F.lit("name_f")).otherwise(F.lit("name_m"))).otherwise(F.lit("surname")))
    return parts.withColumn("kind", kind).select("key", "at", "part", "kind", "token", normal(F.col("kind"), F.col("token")).alias("value"))


def _digits(hexes: Column) -> Column:
    """64 decimal digits from 64 hexadecimal ones."""
    return F.concat(*[F.substring(F.lpad(F.conv(F.substring(hexes, 1 + 15 * i, 15), 16, 10), 20, "0"), 5, 16) for i in range(4)])


def _luhn_sum(digits: Column, odd: int) -> Column:
    """The Luhn sum, doubling the digits whose place from the right has the parity ``odd`` (0: the last is at 1)."""
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(i: Column) -> Column:
        d = F.substring(F.reverse(digits), 1, 64).substr(i, F.lit(1)).cast("int")
        twice = 2 * d
        return F.when(F.pmod(i + odd, F.lit(2)) == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, b: a + b)


def _letters(hexes: Column, count: int) -> Column:
    return F.translate(F.substring(hexes, 1, count), "0123456789abcdef", "abcdeghiklmnoprs")


def _name(hexes: Column, script: str, kind: Column, syllables: Column) -> Column:
    consonants, vowels = SYLLABLES[script]
    m, f, s = ENDINGS[script]

    def syllable(i: Column) -> Column:
        n = F.conv(F.substr(hexes, 1 + 4 * i, F.lit(4)), 16, 10).cast("int")
        return F.concat(F.substr(F.lit(consonants), 1 + F.pmod(n, F.lit(len(consonants))), F.lit(1)),
                        F.substr(F.lit(vowels), 1 + F.pmod(F.floor(n / len(consonants)).cast("int"), F.lit(len(vowels))), F.lit(1)))
    body = F.array_join(F.transform(F.sequence(F.lit(0), syllables - 1), syllable), "")
    return F.concat(body, F.when(kind == "name_m", F.lit(m)).when(kind == "name_f", F.lit(f)).otherwise(F.lit(s)))


def candidate(kind: Column, value: Column, key: str, attempt: int) -> Column:
    """The normalised surrogate that an entity draws at an attempt."""
    hexes = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, F.lit(str(attempt))).cast("binary"), 256)
    long = F.concat(hexes, F.sha2(hexes.cast("binary"), 256))
    digits, n = _digits(hexes), F.length(value)
    body = F.concat(F.substring(value, 1, 1), F.substr(digits, F.lit(1), n - 2))
    check = F.pmod(10 - F.pmod(_luhn_sum(body, 1), F.lit(10)), F.lit(10)).cast("string")
    card = F.concat(body, check)
    octet = lambda i: F.conv(F.substring(hexes, 1 + 2 * i, 2), 16, 10).cast("int")
    ip = F.concat_ws(".", (240 + F.pmod(octet(0), F.lit(16))).cast("string"), *(octet(i).cast("string") for i in (1, 2, 3)))
    ip6 = F.concat_ws(":", F.lit("fd00"), *(F.substring(hexes, 1 + 4 * i, 4) for i in range(7)))
    local = F.concat(_letters(hexes, 12), F.when(value.rlike(r"^[^@]*\."), F.lit(".")).otherwise(F.lit("")),
                     F.when(value.rlike(r"^[^@]*\d"), F.substring(digits, 1, 2)).otherwise(F.lit("")))
    email = F.concat(local, F.lit("@mail"), F.substring(digits, 20, 4), F.lit(".example.org"))
    # A secret keeps its key prefix; the rest is hexadecimal, which every format allows.
    head = F.regexp_extract(value, r"^(AKIA|gh[pousr]_|sk[-_])", 1)
    secret = F.concat(head, F.substr(F.repeat(long, 1 + F.floor(n / 128).cast("int")), F.lit(1), n - F.length(head)))
    country, account = F.substring(value, 1, 2), F.substr(digits, F.lit(1), n - 4)
    iban = F.concat(country, F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)
    count = F.lit(3 + min(attempt, 12))
    name = F.when(value.rlike(r"\p{IsCyrillic}"), _name(hexes, "cyrillic", kind, count)) \
        .when(value.rlike(r"\p{IsGreek}"), _name(hexes, "greek", kind, count)).otherwise(_name(hexes, "latin", kind, count))
    return (F.when(kind == "email", email).when(kind == "secret", secret).when(kind == "iban", iban).when(kind == "ip", ip)
            .when(kind == "ip6", ip6).when(kind == "ssn", F.concat(F.lit("9"), F.substring(digits, 1, 8))).when(kind == "card", card)
            .when(kind == "phone", F.substr(digits, F.lit(1), n)).otherwise(name))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value), with no two alike and none a real value."""
    every = stored(entities.select("kind", "value").distinct(), "entities")
    todo, done = every, None
    for attempt in range(MAX_ATTEMPTS):
        drawn = todo.withColumn("surrogate", candidate(F.col("kind"), F.col("value"), key, attempt))
        free = drawn.join(every.select("kind", F.col("value").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done, ["kind", "surrogate"], "left_anti")
        won = stored(free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).select("kind", "value", "surrogate"), "surrogates")
        done = won if done is None else stored(done.unionByName(won), "surrogates")
        todo = stored(todo.join(won, ["kind", "value"], "left_anti").select("kind", "value"), "unresolved")
        if todo.isEmpty():
            return done
    raise RuntimeError(f"no distinct surrogates for some entities after {MAX_ATTEMPTS} attempts")


def rendered(kind: Column, token: Column, surrogate: Column) -> Column:
    """The surrogate in the format of an occurrence."""
    total = F.length(F.regexp_replace(token, r"\D", ""))
    keep = total - F.length(surrogate)  # leading digits that stay, such as a country prefix

    def put(done: Column, c: Column) -> Column:
        at = done["at"]
        digit = c.rlike("[0-9]")
        return F.struct(F.concat(done["text"], F.when(digit & (at >= keep), F.substr(surrogate, at - keep + 1, F.lit(1))).otherwise(c)).alias("text"),
                        F.when(digit, at + 1).otherwise(at).alias("at"))

    def place(done: Column, c: Column) -> Column:
        at = done["at"]
        return F.struct(F.concat(done["text"], F.when(c == " ", c).otherwise(F.substr(surrogate, at + 1, F.lit(1)))).alias("text"),
                        F.when(c == " ", at).otherwise(at + 1).alias("at"))

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    numbers = F.aggregate(F.split(token, ""), start, put, lambda d: d["text"])
    spaced = F.aggregate(F.split(token, ""), start, place, lambda d: d["text"])
    loud = (token == F.upper(token)) & token.rlike(r"\p{Lu}")
    word = F.when(loud & (F.length(token) > 1), F.upper(surrogate)).when(kind.isin("name_m", "name_f", "surname"), F.initcap(surrogate)).otherwise(surrogate)
    return F.when(kind.isNull(), token).when(kind.isin("phone", "card", "ssn"), numbers).when(kind == "iban", spaced).otherwise(word)


def replace(df: DataFrame, text: str = "text", key: str = "", count: str | None = None) -> DataFrame:
    """The rows of ``df`` with the entities of ``text`` replaced; ``count`` names a column for the number of entities."""
    if not key:
        raise ValueError("a secret key is needed")
    mark, made, many, body = fresh(df, "mark"), fresh(df, "made"), fresh(df, "many"), F.col(text)
    names = [c for c in df.columns if c != count]
    hashed = df.withColumn(mark, F.sha2(body.cast("binary"), 256))
    held = F.when(body.rlike(GATE), F.size(matches(body)) > 0).otherwise(False)
    parts = stored(occurrences(hashed.where(held), text, mark), "occurrences")
    known = surrogates(parts.where("kind is not null"), key)
    shown = (parts.join(known, ["kind", "value"], "left")
             .select(F.col("kind").isNotNull().alias("named"), "key", "at", "part", rendered(F.col("kind"), F.col("token"), F.col("surrogate")).alias("shown")))
    whole = shown.groupBy("key", "at").agg(F.array_join(F.array_sort(F.collect_list(F.struct("part", "shown")))["shown"], " ").alias("shown"), F.max("named").alias("named"))
    lists = whole.groupBy("key").agg(F.count_if("named").alias(many), F.array_sort(F.collect_list(F.struct("at", "shown")))["shown"].alias(made)).withColumnRenamed("key", mark)
    pieces = F.zip_with(F.split(body, ANY, -1), F.concat(F.col(made), F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    changed = hashed.where(held).join(lists, mark)
    numbered = lambda rows, n: rows.withColumn(count, n.cast("long")) if count else rows
    changed = numbered(changed, F.col(many)).withColumn(text, F.array_join(pieces, ""))
    same = numbered(df.where(~held | body.isNull()), F.lit(0))
    out = [*names, count] if count else names
    return same.select(out).unionAll(changed.select(out))
