"""Personal data replaced by keyed, type-consistent surrogates, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalframe.plans.staging import stage

#: Rounds of new surrogates for those that collide; what still does gets a longer one.
ROUNDS = 8

# Patterns of the entities.
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"
HEX = r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,64}(?![0-9A-Za-z])"
KEY = r"(?<![0-9A-Za-z])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,60}|sk-[A-Za-z0-9]{20,60})(?![0-9A-Za-z])"
IPV6 = r"(?<![0-9A-Za-z:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![0-9A-Za-z:])"
IPV4 = r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![0-9A-Za-z]|\.\d)"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,6} ?\d{1,4}(?![0-9A-Za-z])"
CARD = r"(?<![0-9A-Za-z.])\d(?:[ \-]?\d){12,18}(?![0-9A-Za-z])"
SSN = r"(?<![0-9A-Za-z\-])\d{3}-\d{2}-\d{4}(?![0-9A-Za-z\-])"
PHONE = r"(?<![0-9A-Za-z])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}|\(\d{2,4}\) ?\d{3,4}[ .\-]\d{3,4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?![0-9A-Za-z])"
MALE, FEMALE = "Mr|Herr|Monsieur|Señor|Sr|Sig|Господин", "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Señorita|Госпожа"
PERSON = rf"(?<!\p{{L}})(?:{MALE}|{FEMALE})\.? \p{{Lu}}[\p{{Ll}}'’\-]+(?:\p{{Lu}}\p{{Ll}}+)?(?: \p{{Lu}}[\p{{Ll}}'’\-]+(?:\p{{Lu}}\p{{Ll}}+)?)?"
ENTITY = "|".join((EMAIL, HEX, KEY, IPV6, IPV4, IBAN, CARD, SSN, PHONE, PERSON))
#: What every entity holds: cheap to look for in a text that has none.
HINT = rf"[0-9@]|AKIA|ASIA|gh[pousr]_|sk-|[a-fA-F]{{32}}|[a-fA-F]:[a-fA-F]|{MALE}|{FEMALE}"

# Names by script and gender, and parts of surnames.
GIVEN = {
    "latin m": "James Peter Paul Martin Thomas Daniel Robert Walter Felix Oscar Hugo Simon".split(),
    "latin f": "Anna Clara Emma Julia Laura Maria Nina Olivia Paula Rosa Sarah Vera".split(),
    "cyrillic m": "Алексей Борис Виктор Григорий Денис Иван Максим Николай Олег Павел".split(),
    "cyrillic f": "Анна Вера Галина Дарья Елена Ирина Марина Наталья Ольга Светлана".split(),
}
SURNAME = {
    "latin": ("Ash Black Brook Carl Dal Ever Fair Gold Hart Lang Mar Nor Rad Stan West Wind".split(), "berg born by dale field ford ham land ley man mont ridge son ton well wood".split()),
    "cyrillic": ("Бел Берез Вол Горб Дубр Зим Калин Лес Мороз Новик Орл Петр Сокол Тих".split(), "ак ин ен ов ят".split()),
}

_SCRIPT = r"^\p{IsCyrillic}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def kind_of(e: Column) -> Column:
    whole = [("hex", HEX), ("key", KEY), ("ipv6", IPV6), ("ipv4", IPV4), ("ssn", SSN), ("iban", IBAN), ("card", CARD), ("phone", PHONE)]
    found = F.when(e.contains("@"), "email")
    for name, pattern in whole:
        found = found.when(F.regexp_like(e, F.lit(f"^(?:{pattern})$")), name)
    return found.otherwise("person")


def units_of(e: Column, kind: Column) -> Column:
    """What an entity is made of, as kind and canonical form: spellings of one thing share them."""
    digits = F.regexp_replace(e, r"[^0-9]", "")
    country = F.when(e.startswith("+"), F.regexp_extract(e, r"^\+(\d{1,3})", 1)).otherwise("")
    canon = (
        F.when(kind.isin("email", "hex", "ipv6"), F.lower(e))
        .when(kind == "iban", F.regexp_replace(e, " ", ""))
        .when(kind.isin("card", "ssn"), F.concat(F.lit("|"), digits))
        .when(kind == "phone", F.concat(country, F.lit("|"), digits))
        .otherwise(e)
    )
    single = F.array(F.struct(kind.alias("kind"), canon.alias("canon")))
    return F.when(kind == "person", let(F.split(e, " "), person_units)).otherwise(single)


def person_units(words: Column) -> Column:
    last = F.element_at(words, -1)
    script = F.when(F.regexp_like(last, F.lit(_SCRIPT)), "cyrillic").otherwise("latin")
    gender = F.when(F.regexp_like(F.element_at(words, 1), F.lit(rf"^(?:{MALE})\.?$")), "m").otherwise("f")
    # Cyrillic surnames take the ending of the gender, so it is left out of what names the family
    family = F.when(script == "cyrillic", F.regexp_replace(F.lower(last), "а$", "")).otherwise(F.lower(last))
    surname = F.struct(F.lit("surname").alias("kind"), F.concat_ws("|", script, family).alias("canon"))
    given = F.struct(F.lit("given").alias("kind"), F.concat_ws("|", F.concat_ws(" ", script, gender), F.lower(F.element_at(words, 2))).alias("canon"))
    return F.when(F.size(words) > 2, F.array(given, surname)).otherwise(F.array(surname))


def number_at(stream: Column, place: Column) -> Column:
    """The number, 0 to 255, at a place (from 0) of a hexadecimal stream, which repeats."""
    return F.conv(F.substring(stream, F.pmod(place, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def morphed(text: Column, stream: Column) -> Column:
    """Every ASCII letter by a letter of its case, every digit by a digit."""
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def sign(i: Column) -> Column:
        c, n = F.substring(text, i, F.lit(1)), number_at(stream, i)
        return let(F.struct(c.alias("c"), n.alias("n")), changed)

    def changed(x: Column) -> Column:
        letter = lambda letters: F.substring(F.lit(letters), x.n % 26 + 1, F.lit(1))
        return F.when(x.c.rlike("[0-9]"), (x.n % 10).cast("string")).when(x.c.rlike("[a-z]"), letter(lower)).when(x.c.rlike("[A-Z]"), letter(upper)).otherwise(x.c)

    return F.when(F.length(text) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), sign), "")).otherwise("")


def luhn(digits: Column) -> Column:
    """The Luhn sum, whose last digit a surrogate keeps."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def _given(script: str, stream: Column) -> Callable[[Column], Column]:
    return lambda k: pick(GIVEN[script], number_at(stream, k))


def _surname(script: str, stream: Column) -> Callable[[Column], Column]:
    starts, ends = SURNAME[script]
    return lambda k: F.concat(pick(starts, number_at(stream, k * 2)), pick(ends, number_at(stream, k * 2 + 1)))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The canonical surrogate of a unit: a keyed function of its kind, canonical form and the attempt."""
    block = [F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"), F.lit(str(k))), 256) for k in range(2)]
    return let(F.concat(*block), lambda stream: _surrogate(kind, canon, attempt, stream))


def _surrogate(kind: Column, canon: Column, attempt: Column, stream: Column) -> Column:
    prefix = F.regexp_extract(canon, r"^(AKIA|ASIA|gh[pousr]_|sk-)", 1)
    group = F.split_part(canon, F.lit("|"), F.lit(1))
    times = F.sequence(F.lit(0), attempt.cast("int"))
    names = families = F.lit(None).cast("string")
    for script in GIVEN:
        names = F.when(group == script, F.array_join(F.transform(times, _given(script, stream)), "-")).otherwise(names)
    for script in SURNAME:
        families = F.when(group == script, F.array_join(F.transform(times, _surname(script, stream)), "-")).otherwise(families)
    return (
        F.when(kind == "email", F.concat(morphed(F.regexp_extract(canon, r"^(.*)(\.[^.]*)$", 1), stream), F.regexp_extract(canon, r"^(.*)(\.[^.]*)$", 2)))
        .when(kind == "hex", F.substring(stream, F.lit(1), F.length(canon)))
        .when(kind == "key", F.concat(prefix, morphed(F.substring(canon, F.length(prefix) + 1, F.length(canon)), stream)))
        .when(kind == "ipv6", F.array_join(F.transform(F.split(canon, ":"), lambda p, i: F.substring(stream, i * 4 + 1, F.length(p))), ":"))
        .when(kind == "ipv4", let(F.split(canon, r"\."), lambda octets: _address(octets, stream)))
        .when(kind == "iban", F.concat(F.substring(canon, F.lit(1), F.lit(2)), morphed(F.substring(canon, F.lit(3), F.length(canon)), stream)))
        .when(kind.isin("card", "phone", "ssn"), let(F.split(canon, r"\|"), lambda parts: _number(parts, stream, kind == "card")))
        .when(kind == "given", F.concat_ws("|", group, names))
        .otherwise(F.concat_ws("|", group, families))
    )


def _address(octets: Column, stream: Column) -> Column:
    """Private networks stay private, in their first two numbers."""
    first, second = F.element_at(octets, 1), F.element_at(octets, 2)
    private = first.isin("10", "127") | (first == "192") & (second == "168") | (first == "172") & second.cast("int").between(16, 31)
    made = [(number_at(stream, F.lit(k)) % most + least).cast("string") for k, (most, least) in enumerate([(100, 11), (256, 0), (256, 0), (254, 1)])]
    return F.concat_ws(".", F.when(private, first).otherwise(made[0]), F.when(private, second).otherwise(made[1]), *made[2:])


def _number(parts: Column, stream: Column, card: Column) -> Column:
    """Digits behind the country code are drawn; the last one of a card number keeps the Luhn sum's last digit."""
    country, digits = F.element_at(parts, 1), F.element_at(parts, 2)

    def digit(i: Column) -> Column:
        return F.when(i <= F.length(country), F.substring(digits, i, F.lit(1))).otherwise((number_at(stream, i) % 10).cast("string"))

    def checked(drawn: Column) -> Column:
        body = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
        return F.concat(body, F.pmod(luhn(digits) - luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))

    drawn = F.array_join(F.transform(F.sequence(F.lit(1), F.length(digits)), digit), "")
    return F.concat(country, F.lit("|"), F.when(card, let(drawn, checked)).otherwise(drawn))


def laid(e: Column, signs: Column, pattern: str) -> Column:
    """``e`` with the characters that match ``pattern`` replaced by ``signs``, one after the other; more signs follow at the end."""

    def sign(i: Column) -> Column:
        c = F.substring(e, i, F.lit(1))
        before = F.length(F.regexp_replace(F.substring(e, F.lit(1), i), f"(?!{pattern}).", ""))
        return F.when(c.rlike(pattern), F.substring(signs, before, F.lit(1))).otherwise(c)

    more = F.substring(signs, F.length(F.regexp_replace(e, f"(?!{pattern}).", "")) + 1, F.length(signs))
    return F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.length(e)), sign), ""), more)


def rendered(e: Column, kind: Column, units: Column) -> Column:
    """Canonical surrogates in the format and case of the entity."""
    return let(units, lambda u: let(F.split(e, " "), lambda words: _rendered(e, kind, u, words)))


def _rendered(e: Column, kind: Column, units: Column, words: Column) -> Column:
    first = F.element_at(units, 1)
    value = lambda u: F.split_part(u, F.lit("|"), F.lit(2))
    female = F.regexp_like(F.element_at(words, 1), F.lit(rf"^(?:{FEMALE})\.?$"))
    family = value(F.element_at(units, -1))
    family = let(family, lambda f: F.concat(f, F.when(female & F.regexp_like(f, F.lit(r"^\p{IsCyrillic}.*(?:ов|ин|ен)$")), "а").otherwise("")))
    plain = (
        F.when(kind.isin("card", "phone", "ssn"), laid(e, value(first), "[0-9]"))
        .when(kind == "iban", laid(e, first, "[0-9A-Z]"))
        .when(kind == "person", F.concat_ws(" ", F.element_at(words, 1), F.when(F.size(units) > 1, value(first)), family))
        .otherwise(first)
    )
    shouted = (e == F.upper(e)) & e.rlike("[A-Za-z]") & kind.isin("email", "hex", "ipv6")
    return let(plain, lambda p: F.when(shouted, F.upper(p)).otherwise(p))


def with_entities(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the entities of the text in order: spelling, kind, units."""
    found = F.when(F.regexp_like("text", F.lit(HINT)), F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
    found = F.coalesce(found, F.array().cast("array<string>"))
    listed = docs.select("doc_id", "text", F.transform(found, lambda e: F.struct(e.alias("e"), kind_of(e).alias("kind"))).alias("found"))
    return listed.withColumn("found", F.transform("found", lambda x: F.struct(x.e.alias("e"), x.kind.alias("kind"), units_of(x.e, x.kind).alias("units"))))


def settled(units: DataFrame, key: str, made: Callable[..., Column] = surrogate, rounds: int = ROUNDS) -> DataFrame:
    """For the distinct units (kind, canon) whose first surrogate collides, the attempt that does not: kind, canon, attempt.

    A surrogate collides if it is a unit of the corpus itself, or was given to
    another unit; of several at once, the smallest unit gets it.  Attempts from
    ``rounds`` on are not checked: they carry a longer stretch of the keyed
    digest, which tells them apart.  Runs jobs.
    """
    waiting, taken, late = units, None, None
    for attempt in range(rounds + 1):
        tried = stage(waiting.withColumn("made", made(F.col("kind"), F.col("canon"), F.lit(attempt), key)), "surrogates")
        if attempt == rounds:
            given = tried
        else:
            free = tried.join(units.select("kind", F.col("canon").alias("made")), ["kind", "made"], "left_anti")
            if taken is not None:
                free = free.join(taken, ["kind", "made"], "left_anti")
            given = stage(free.groupBy("kind", "made").agg(F.min("canon").alias("canon")), "given")
        if attempt:
            now = given.select("kind", "canon", F.lit(attempt).alias("attempt"))
            late = now if late is None else late.union(now)
        waiting = stage(tried.select("kind", "canon").join(given.select("kind", "canon"), ["kind", "canon"], "left_anti"), "waiting")
        if attempt == rounds or waiting.isEmpty():
            break
        taken = given.select("kind", "made") if taken is None else taken.union(given.select("kind", "made"))
    return late if late is not None else units.select("kind", "canon", F.lit(0).alias("attempt")).limit(0)


def distinguished(made: Column, kind: Column, canon: Column, attempt: Column, key: str, rounds: int = ROUNDS) -> Column:
    """A surrogate of the last attempt, made longer by digits or letters of the keyed digest."""
    tail = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("tail"), kind, canon), 256)
    digits, letters = F.translate(tail, "abcdef", "012345"), F.translate(tail, "0123456789", "ghijklmnop")
    longer = F.when(kind.isin("card", "phone", "ssn", "ipv4", "iban"), F.concat(made, digits)).when(kind == "email", F.concat(letters, F.lit("."), made)).otherwise(F.concat(made, letters))
    return F.when(attempt >= rounds, longer).otherwise(made)


def replaced(docs: DataFrame, key: str, made: Callable[..., Column] = surrogate, rounds: int = ROUNDS) -> DataFrame:
    """Documents (doc_id, text) with every detected entity replaced: doc_id, text, n_entities, kinds.

    Found are e-mail and IP addresses, keys and hexadecimal secrets, bank, card
    and social security numbers, telephone numbers, and persons behind a form of
    address.  A surrogate is a function of the key and of the entity's
    canonical form, so an entity has the same one everywhere, whatever its
    spelling; gender, script, digits, case and punctuation stay of their kind.
    Over all of the corpus, different entities get different surrogates, and no
    surrogate is an entity of the corpus (``settled``).

    ``kinds`` are the distinct kinds found, sorted.  Null text stays null with no
    entities; rows that repeat are all returned, a null doc_id included.  The
    original values are not returned.  Runs jobs.
    """
    listed = with_entities(docs.select("doc_id", "text"))
    held = listed.filter(F.size("found") > 0)
    units = stage(held.select(F.explode(F.flatten("found.units")).alias("u")).select("u.*").distinct(), "units")
    late = stage(settled(units, key, made, rounds), "attempts")
    attempts = F.lit(None).cast("map<string,int>")
    if not late.isEmpty():
        named = held.select("doc_id", F.explode(F.array_distinct(F.flatten("found.units"))).alias("u")).select("doc_id", "u.*").distinct()
        per_doc = named.join(late, ["kind", "canon"]).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "kind", "canon"), "attempt"))).alias("_attempts"))
        per_doc = stage(per_doc.withColumnRenamed("doc_id", "_id"), "attempts-by-document")
        listed = listed.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
        attempts = F.col("_attempts")

    def resolved(u: Column) -> Column:
        attempt = F.coalesce(F.element_at(attempts, F.concat_ws(":", u.kind, u.canon)), F.lit(0))
        return let(attempt, lambda a: let(made(u.kind, u.canon, a, key), lambda m: distinguished(m, u.kind, u.canon, a, key, rounds)))

    given = F.transform("found", lambda x: rendered(x.e, x.kind, F.transform(x.units, resolved)))
    gaps = F.split("text", ENTITY, -1)
    text = F.array_join(F.flatten(F.zip_with(gaps, given, lambda gap, value: F.array(gap, F.coalesce(value, F.lit(""))))), "")
    return listed.select(
        "doc_id", F.when(F.size("found") > 0, text).otherwise(F.col("text")).alias("text"),
        F.size("found").alias("n_entities"), F.array_sort(F.array_distinct("found.kind")).alias("kinds"),
    )
