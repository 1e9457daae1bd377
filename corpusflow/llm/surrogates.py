"""PII surrogates: detected entities get keyed replacements of the same type, script, gender and format.

Detection. One pattern finds e-mail addresses, access keys, secrets after ``password=`` and the like,
phone numbers, IBANs, IPv4 addresses, card numbers, social security numbers, and person names after a
title or as a known given name before a further name.

Surrogate. ``sha256(key | type | entity | attempt)`` drives the replacement: digits become digits,
letters letters of the same case and script (Latin, Greek, Cyrillic, Han, kana, Hangul, Hebrew, Arabic, Thai,
Devanagari; letters, marks and digits of other scripts become Latin letters), other characters stay. Fixed parts
stay too: an address' last domain label, a phone's country code, ``AKIA``, an IBAN's country. IPv4 parts
stay in range and a card that passes the Luhn check gets one that passes. Names are built from syllables of
their script; given names end as names of their gender (from the title, else from the list).

Coreference and distinctness. Equal entities (e-mail addresses and names: in any case) get equal
surrogates everywhere, as these depend on nothing else. All distinct entities of the corpus are checked: where two
of a type would share a surrogate, or a surrogate is itself an entity of the corpus, all but the first
take the next attempt, until none clashes. From attempt ``WIDEN`` on secrets and addresses grow longer, so
that short ones don't run out of surrogates. What a fixed format has no surrogate left for after
``MAX_ATTEMPTS`` gets its type and a keyed digest, which is distinct and stable but not of the format. The check joins and aggregates distinct entities, so a hot
entity costs a row per task.

Plan. Detection and replacement are built-in functions. Documents without entities are passed on as
they are; of the others only (text hash, entities) move, and their texts meet the surrogates in a join
on the text's hash.

Defined cases: a secret that is one repeated character other than a letter, mark or digit (``******``) is a mask and
stays; one of several such characters becomes Latin letters; null text stays null, empty text empty, both with no entities; repeated rows get equal
texts; an empty table gives no rows. Extra columns are kept; columns named ``n_entities`` or
``entity_types`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.session import ensure_checkpoint_dir

KEY = "corpusflow"
MAX_ATTEMPTS = 64
WIDEN = 8  # attempts by the entity's own form only

FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Sra", "Señora", "Mme", "Madame", "Госпожа")
MALE_TITLES = ("Mr", "Sir", "Herr", "Sr", "Señor", "Monsieur", "Господин")
PLAIN_TITLES = ("Dr", "Prof")
FEMALE_NAMES = ("Anna", "Maria", "Mary", "Laura", "Julia", "Sofia", "Elena", "Sarah", "Emma", "Marie", "Carmen", "Ingrid",
                "Анна", "Мария", "Елена", "Ольга")
MALE_NAMES = ("John", "Peter", "Paul", "David", "Thomas", "Carlos", "Juan", "Hans", "Pierre", "Michael", "James", "Robert",
              "Иван", "Пётр", "Алексей", "Сергей")
LATIN_SYLLABLES = ("ba", "do", "fe", "ga", "ka", "le", "mi", "no", "pa", "ri", "sa", "to", "ve", "zu", "lo", "ne")
CYRILLIC_SYLLABLES = ("ба", "до", "фе", "га", "ка", "ле", "ми", "но", "па", "ри", "са", "то", "ве", "зу", "ло", "не")

_TITLE = "(?:" + "|".join((*FEMALE_TITLES, *MALE_TITLES, *PLAIN_TITLES)) + r")\.?"
_GIVEN = "(?:" + "|".join((*FEMALE_NAMES, *MALE_NAMES)) + ")"
_NAME = r"\p{Lu}[\p{L}'’-]{1,30}(?![\p{L}])"

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
ACCESS_KEY = r"\bAKIA[0-9A-Z]{16}\b"
# the cheap look at one or two characters comes first in each part, as every place of a text is tried
SECRET = r"(?<=[=:\"]|[=:] )(?<=\b(?:password|passwd|secret|token|api_key) ?[=:] ?\"?)[^\s\"=:,;]{6,}"
PHONE = r"(?=\+)(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3}[ .-]?\d{3,4}(?!\d)"
IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"(?=\d)(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)"
CARD = r"(?=\d)(?<![\d.-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{13,19})(?![\d-])"
SSN = r"(?=\d)(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PERSON = rf"(?=\p{{Lu}})(?<![\p{{L}}])(?:(?<={_TITLE} ){_NAME}|(?<={_TITLE} \p{{Lu}}[\p{{L}}'’-]{{1,30}} ){_NAME}|{_GIVEN}(?= {_NAME})|(?<={_GIVEN} ){_NAME})"
PATTERN = "|".join((EMAIL, ACCESS_KEY, SECRET, PHONE, IBAN, IPV4, CARD, SSN, PERSON))


def _kind(entity: Column, before: Column, after: Column) -> Column:
    """Type of an entity, from its form and, for names, from the text around it."""

    def form(p):
        return F.rlike(entity, F.lit("^(?:" + p + ")$"))

    def titled(titles):
        return F.rlike(before, F.lit(r"(?<![\p{L}])(?:" + "|".join(titles) + r")\.? $"))

    more = after == " "  # a name follows at once
    given = F.when(titled(FEMALE_TITLES), "given_f").when(titled(MALE_TITLES), "given_m").when(
        entity.isin(*FEMALE_NAMES), "given_f").when(entity.isin(*MALE_NAMES), "given_m").otherwise("surname")
    return (F.when(form(EMAIL), "email").when(form(ACCESS_KEY), "access_key").when(form(PHONE), "phone")
            .when(form(IPV4), "ip").when(form(SSN), "ssn").when(form(CARD), "card").when(form(IBAN), "iban")
            .when(F.rlike(before, F.lit(r"[=:] ?\"?$")), "secret").when(more, given).otherwise("surname"))


def _norm(kind: Column, entity: Column) -> Column:
    return F.when(kind.isin("email", "given_f", "given_m", "surname"), F.lower(entity)).otherwise(entity)


def detect(docs: DataFrame, text: str) -> DataFrame:
    """Every input column, and ``_pieces`` (the text around entities) and ``_ents`` (entity, kind, norm), in order."""
    t = F.col(text).cast("string")
    found = docs.withColumn("_found", F.coalesce(F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0)), F.array().cast("array<string>")))
    found = found.withColumn("_pieces", F.when(F.size("_found") > 0, F.split(t, PATTERN, -1)))

    def one(e, i):
        kind = _kind(e, F.element_at("_pieces", i + 1), F.element_at("_pieces", i + 2))
        return F.struct(e.alias("entity"), kind.alias("kind"), _norm(kind, e).alias("norm"))

    return found.withColumn("_ents", F.transform("_found", one)).drop("_found")


def _hex(i) -> Column:
    """Pseudo-random number for place ``i``, from the digest in column ``_d`` (renewed every 16 places)."""
    block = F.sha2(F.concat_ws("|", F.col("_d"), F.floor(i / 16).cast("string")).cast("binary"), 256)
    return F.conv(F.substring(block, (i % 16 * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")


_RANGES = ((0x61, 26), (0x41, 26), (0x30, 10), (0xE0, 23), (0xC0, 23), (0x430, 32), (0x410, 32), (0x3B1, 17), (0x391, 17),
           (0x4E00, 20000), (0x3041, 83), (0x30A1, 83), (0xAC00, 11000), (0x5D0, 27), (0x621, 26), (0x641, 10), (0xE01, 46),
           (0x905, 53), (0x93E, 15))  # first code point and number of characters

_CHARACTER = r"[\p{L}\p{M}\p{N}]"
_MASK = r"^([^\p{L}\p{M}\p{N}])\1*$"


def _mapped(s: Column, offset: int = 0) -> Column:
    """Each letter or digit of ``s`` replaced by one of the same range; outside the ranges by a Latin letter."""

    def one(c, i):
        code, r = F.ascii(c), _hex(i + offset)
        out = F.when(F.rlike(c, F.lit(_CHARACTER)), _char(F.lit(0x61) + r % 26)).otherwise(c)
        for first, n in reversed(_RANGES):
            to = F.when(code.between(first, first + n - 1), _char(F.lit(first) + r % n))
            out = F.coalesce(to, out)
        return out

    return F.array_join(F.transform(F.split(s, ""), one), "")


def _letters(s: Column, offset: int = 0) -> Column:
    """A Latin letter for each character of ``s``, of whatever kind."""
    return F.array_join(F.transform(F.split(s, ""), lambda c, i: _char(F.lit(0x61) + _hex(i + offset) % 26)), "")


def _char(code: Column) -> Column:
    """The character of a code point (``char`` stops at 255)."""
    two = F.unhex(F.lpad(F.conv(code.cast("string"), 10, 16), 4, "0"))
    return F.decode(two, "UTF-16BE")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits, the last one counted as it is."""
    def add(acc, x):
        return acc + x

    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(each, F.lit(0), add)


def _name(kind: Column, norm: Column, attempt: Column) -> Column:
    cyrillic = F.rlike(norm, F.lit(r"\p{IsCyrillic}"))
    n = F.lit(3) + F.floor(attempt / 4).cast("int")
    lat, cyr = F.lit(list(LATIN_SYLLABLES)), F.lit(list(CYRILLIC_SYLLABLES))
    body = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(
        F.when(cyrillic, cyr).otherwise(lat), _hex(i) % 16 + 1)), "")
    tail = (F.when(kind == "given_f", F.when(cyrillic, "на").otherwise("na"))
            .when(kind == "given_m", F.when(cyrillic, "н").otherwise("n"))
            .otherwise(F.when(cyrillic, "ров").otherwise("rel")))
    return F.concat(body, tail)


def surrogate(kind: Column, norm: Column, attempt: Column) -> Column:
    """Replacement of an entity; reads the digest column ``_d``."""
    more = F.repeat(F.lit("x"), F.greatest(attempt - (WIDEN - 1), F.lit(0)))  # one longer at each attempt
    longer = F.when(attempt >= WIDEN, _letters(more, 1000)).otherwise("")
    email = F.concat(longer, _mapped(F.regexp_extract(norm, r"^(.*)\.[^.]*$", 1)), F.regexp_extract(norm, r"\.[^.]*$", 0))
    phone = F.concat(F.regexp_extract(norm, r"^\+\d{1,3}(?=[ .(-])|^\+\d", 0),
                     _mapped(F.regexp_replace(norm, r"^\+\d{1,3}(?=[ .(-])|^\+\d", "")))
    ip = F.array_join(F.transform(F.split(norm, r"\."), lambda x, i: (_hex(i) % 254 + 1).cast("string")), ".")
    digits = F.regexp_replace(norm, r"\D", "")
    drawn = F.concat(F.substring(norm, 1, 1), _mapped(F.regexp_replace(norm, r"^.", "")))
    stem = F.regexp_replace(drawn, r".$", "")
    last = ((F.lit(10) - _luhn(F.concat(F.regexp_replace(stem, r"\D", ""), F.lit("0"))) % 10) % 10).cast("string")
    card = F.when(_luhn(digits) % 10 == 0, F.concat(stem, last)).otherwise(drawn)
    key = F.concat(F.lit("AKIA"), _mapped(F.regexp_replace(norm, "^AKIA", "")))
    iban = F.concat(F.substring(norm, 1, 2), _mapped(F.regexp_replace(norm, r"^..", "")))
    secret = F.when((attempt >= WIDEN) | ~F.rlike(norm, F.lit(_CHARACTER)), _letters(F.concat(norm, more))).otherwise(_mapped(norm))
    return (F.when(kind == "email", email).when(kind == "secret", secret).when(kind == "phone", phone).when(kind == "ip", ip).when(kind == "card", card)
            .when(kind == "access_key", key).when(kind == "iban", iban)
            .when(kind.isin("given_f", "given_m", "surname"), _name(kind, norm, attempt)).otherwise(_mapped(norm)))


def assign(entities: DataFrame, key: str = KEY, attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """(kind, norm, sur) for distinct (kind, norm): surrogates that are distinct within a kind and no entity themselves."""

    def with_surrogate(df, n):
        d = F.sha2(F.concat_ws("|", F.lit(key), "kind", "norm", F.lit(str(n))).cast("binary"), 256)
        return df.withColumn("_d", d).withColumn("sur", surrogate(F.col("kind"), F.col("norm"), F.lit(n))).drop("_d")

    mask = (F.col("kind") == "secret") & F.rlike("norm", F.lit(_MASK))  # tells nothing, and stays
    todo, done = entities.filter(~mask), entities.filter(mask).select("kind", "norm", F.col("norm").alias("sur"))
    real = entities.select("kind", F.col("norm").alias("sur")).distinct()
    for n in range(attempts):
        drawn = with_surrogate(todo, n)
        first = F.row_number().over(Window.partitionBy("kind", "sur").orderBy("norm")) == 1
        taken = real.unionByName(done.select("kind", "sur"))
        drawn = (drawn.withColumn("first", first)
                 .join(taken.withColumn("clash", F.lit(True)).distinct(), ["kind", "sur"], "left").checkpoint())
        ok = F.col("first") & F.col("clash").isNull()
        got = drawn.filter(ok).select("kind", "norm", "sur")
        done = done.unionByName(got)
        todo = drawn.filter(~ok).select("kind", "norm")
        if todo.isEmpty():
            return done
    digest = F.sha2(F.concat_ws("|", F.lit(key), "kind", "norm").cast("binary"), 256)
    return done.unionByName(todo.select("kind", "norm", F.concat(F.lit("["), "kind", F.lit(":"), digest, F.lit("]")).alias("sur")))


def _cased(entity: Column, sur: Column, kind: Column) -> Column:
    """A surrogate of an entity that is known in any case, written like the mention."""
    upper = entity == F.upper(entity)
    word = F.when(upper & (F.length(entity) > 1), F.upper(sur)).otherwise(F.initcap(sur))
    return F.when(F.startswith(sur, F.lit("[")), sur).when(kind.isin("given_f", "given_m", "surname"), word).when(
        (kind == "email") & upper & (entity != F.lower(entity)), F.upper(sur)).otherwise(sur)


def replace_pii(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """Every input column with ``text`` replaced, and ``n_entities`` and ``entity_types`` (sorted, distinct)."""
    ensure_checkpoint_dir(docs.sparkSession)
    own = [c for c in docs.columns if c.lower() not in ("n_entities", "entity_types")]
    # numbered inside, so that no name of the input meets one of the work columns
    inner, h = {c: f"c{i}" for i, c in enumerate(own)}, "_h"
    text = inner[text]
    base = docs.select(*[F.col(c).alias(i) for c, i in inner.items()])
    back, has = [F.col(i).alias(c) for c, i in inner.items()], F.coalesce(F.rlike(F.col(text).cast("string"), F.lit(PATTERN)), F.lit(False))
    some = detect(base.filter(has), text).withColumn(h, F.sha2(F.col(text).cast("string").cast("binary"), 256))
    # one row for each distinct text with entities: narrow, and reread below
    each = some.select(F.col(h).alias("h"), "_ents").dropDuplicates(["h"]).checkpoint()
    mention = each.select("h", F.posexplode("_ents").alias("i", "e")).select("h", "i", "e.*")
    table = assign(mention.select("kind", "norm").distinct().checkpoint(), key)
    out = (mention.join(table, ["kind", "norm"])
           .groupBy("h").agg(F.array_sort(F.collect_list(F.struct("i", _cased(F.col("entity"), F.col("sur"), F.col("kind")).alias("s")))).alias("subs"))
           .select(F.col("h").alias(h), F.col("subs.s").alias("_subs")))
    joined = some.join(out, h)
    # the pieces and the surrogates in turn
    parts = F.transform("_pieces", lambda p, i: F.concat(p, F.coalesce(F.get("_subs", i), F.lit(""))))
    changed = joined.withColumn(text, F.array_join(parts, ""))
    count = F.size("_ents").cast("long").alias("n_entities")
    types = F.array_join(F.array_sort(F.array_distinct(F.col("_ents.kind"))), ",").alias("entity_types")
    plain = base.filter(~has).select(*back, F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("entity_types"))
    return changed.select(*back, count, types).unionByName(plain)
