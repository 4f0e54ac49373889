"""PII surrogates: keyed, type-consistent and distinct replacements (operator 5).

Entities are found by one pattern, normalised (letters lower, numbers as digits)
and summed to one row per (type, normal form). A keyed hash makes the surrogate of
the normal form; it is rendered in the format of each occurrence, so one entity
has one surrogate in all documents, however it is written. Surrogates that two
entities share, or that are somebody's real value, are drawn again until none is.
All of it is built-in functions. Only texts with entities are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.columns import set_aside
from tallyhouse.llm.quality_rules import let
from tallyhouse.operators.rows import next_in_group
from tallyhouse.sources.scratch import materialize

# The patterns of the entity types, earlier ones first where two start at one place.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IPV4 = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?![0-9]|\.[0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
CARD = r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
PHONE = r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9A-Za-z])"
MALE = r"(?:Mr\.?|Herr|Monsieur|Señor|Sr\.|г-н)"
FEMALE = r"(?:Mrs\.?|Ms\.?|Miss|Frau|Madame|Mme\.?|Señora|Sra\.|г-жа)"
NAMED = r"(?<!\p{L})%s\x20\p{Lu}\p{Ll}+(?:\x20\p{Lu}\p{Ll}+)?"
KINDS = {
    "email": EMAIL,
    "ip": IPV4,
    "iban": IBAN,
    "card": CARD,
    "phone": PHONE,
    "male": NAMED % MALE,
    "female": NAMED % FEMALE,
}
ENTITY = "|".join(f"(?:{p})" for p in KINDS.values())
TITLE = rf"^(?:{MALE}|{FEMALE})\x20"
# Given names that surrogates use, by gender and script.
GIVEN = {
    ("male", "latin"): ["Adam", "Bruno", "Colin", "David", "Emil", "Felix", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Paul"],
    ("female", "latin"): ["Alice", "Bella", "Clara", "Diana", "Emma", "Flora", "Helen", "Julia", "Laura", "Maria", "Nora", "Olga"],
    ("male", "cyrillic"): ["Антон", "Борис", "Виктор", "Денис", "Иван", "Олег", "Павел", "Роман"],
    ("female", "cyrillic"): ["Алина", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "Софья"],
}
#: Draws before the entities that are left change places; far more than any space that is not full needs.
DRAWS = 24
INNER = ["_has", "_hash", "_found", "_id", "_h", "news"]


def kind_of(value: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS.items()):
        out = F.when(value.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def normal(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    plain = F.when(kind.isin("card", "phone"), digits).when(kind == "ip", value)
    plain = plain.when(kind == "iban", F.replace(value, F.lit(" "), F.lit("")))
    plain = plain.when(kind.isin("male", "female"), F.lower(F.regexp_replace(value, TITLE, "")))
    return plain.otherwise(F.lower(value))


def noise(key: str, *parts: Column | str) -> tuple[Column, Column]:
    """A long keyed hex string and a function from a place to a number below 65536."""
    whole = F.concat_ws("|", F.lit(key), *[F.lit(p) if isinstance(p, str) else p for p in parts])
    text = F.concat(*[F.sha2(F.concat(whole, F.lit(f"|{b}")), 256) for b in range(4)])
    return text


def number_at(text: Column, place: Column | int) -> Column:
    at = (F.lit(place) if isinstance(place, int) else place) % 64
    return F.conv(F.substring(text, at * 4 + 1, F.lit(4)), 16, 10).cast("int")


def substituted(value: Column, text: Column) -> Column:
    """Each letter and digit replaced by one of its class; other characters stay."""

    def char(c: Column, i: Column) -> Column:
        k = number_at(text, i)
        code = F.ascii(c)
        return (
            F.when(c.rlike("[0-9]"), F.chr(48 + k % 10))
            .when(c.rlike("[a-z]"), F.chr(97 + k % 26))
            .when(c.rlike("[A-Z]"), F.chr(65 + k % 26))
            .when(c.rlike("[а-яё]"), F.substring(F.lit("абвгдежзиклмнопрстуфхэюя"), k % 24 + 1, F.lit(1)))
            .when(c.rlike("[α-ωά-ώ]"), F.substring(F.lit("αβγδεζηθικλμνξοπρστυφχψω"), k % 24 + 1, F.lit(1)))
            .when((code > 127) & c.rlike(r"\p{Ll}"), F.chr(97 + k % 26))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), char), "")


def drawn(key: str, kind: Column, value: Column, draw: Column) -> Column:
    """The surrogate of a normal form."""
    stream = noise(key, kind, value, draw.cast("string"))

    def make(text: Column) -> Column:
        local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
        top = F.substring_index(domain, ".", -1)
        inner = F.substring(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
        # one domain has one surrogate, whoever's address it is in
        mail = F.concat(
            substituted(local, text), F.lit("@"), substituted(inner, noise(key, "domain", domain)), F.lit("."), top
        )
        octets = F.array_join(
            F.transform(F.split(value, r"\."), lambda _, i: (number_at(text, i) % 254 + 1).cast("string")), "."
        )
        # the first digit of a card and of a phone number says what it is
        number = F.concat(F.substring(value, 1, 1), substituted(F.substring(value, F.lit(2), F.length(value)), text))
        iban = F.concat(F.substring(value, 1, 2), substituted(F.substring(value, F.lit(3), F.length(value)), text))
        first = F.substring_index(value, " ", 1)
        last = F.when(F.contains(value, F.lit(" ")), F.substring_index(value, " ", -1))
        given = F.lit(None).cast("string")
        for (gender, script), names in GIVEN.items():
            fits = (kind == gender) & (first.rlike("[а-яё]") if script == "cyrillic" else ~first.rlike("[а-яё]"))
            listed = F.array(*[F.lit(n.lower()) for n in names])
            given = F.when(fits, F.get(listed, number_at(text, 0) % len(names))).otherwise(given)
        # a single name is a family name
        name = F.when(last.isNull(), substituted(first, text)).otherwise(
            F.concat(given, F.lit(" "), substituted(last, text))
        )
        return (
            F.when(kind == "email", mail)
            .when(kind == "ip", octets)
            .when(kind == "iban", iban)
            .when(kind.isin("male", "female"), name)
            .otherwise(number)
        )

    return let(stream, make)


def rendered(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the format of an occurrence."""

    def spread(dense: Column) -> Column:
        """Characters of the surrogate in the places of the occurrence's own."""
        keeps = "[0-9A-Za-z]"
        chars = F.split(value, "")
        return F.array_join(
            F.transform(
                chars,
                lambda c, i: F.when(
                    c.rlike(keeps),
                    F.substring(
                        dense, F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), "[^0-9A-Za-z]", "")), F.lit(1)
                    ),
                ).otherwise(c),
            ),
            "",
        )

    title = F.regexp_extract(value, TITLE, 0)
    named = F.concat(title, F.initcap(surrogate))
    mail = F.when((value == F.upper(value)) & (value != F.lower(value)), F.upper(surrogate)).otherwise(surrogate)
    return (
        F.when(kind.isin("card", "phone", "iban"), spread(surrogate))
        .when(kind.isin("male", "female"), named)
        .when(kind == "ip", surrogate)
        .otherwise(mail)
    )


def surrogates(entities: DataFrame, key: str, draws: int = DRAWS) -> DataFrame:
    """entities (kind, value), distinct, with `surrogate`: distinct per kind and nobody's value.

    Where the values of a format fill most of its space, some entities find no free
    surrogate in DRAWS draws. Real values are barred from the draws, so those of the
    entities that are left are free among themselves: each takes the next one's of its
    format in a keyed order, still distinct.
    """
    gender = F.col("kind").isin("male", "female")
    # names of both genders share one space of values
    now = entities.withColumns({"space": F.when(gender, F.lit("name")).otherwise(F.col("kind")), "draw": F.lit(0)})
    real = entities.select(F.when(gender, F.lit("name")).otherwise(F.col("kind")).alias("space"), F.col("value").alias("surrogate")).distinct()
    for draw in range(draws):
        now = materialize(now.withColumn("surrogate", drawn(key, F.col("kind"), F.col("value"), F.col("draw"))))
        first = now.groupBy("space", "surrogate").agg(
            F.count("*").alias("n"), F.min_by("kind", F.struct("value", "kind")).alias("_kind"), F.min("value").alias("_value")
        )
        taken = first.where("n > 1").select("space", "surrogate", "_kind", "_value").unionByName(
            first.join(real, ["space", "surrogate"], "left_semi").select(
                "space", "surrogate", F.lit(None).cast("string").alias("_kind"), F.lit(None).cast("string").alias("_value")
            )
        )
        taken = materialize(
            taken.groupBy("space", "surrogate").agg(
                F.max("_kind").alias("_kind"), F.max("_value").alias("_value"), F.count_if(F.col("_value").isNull()).alias("_real")
            )
        )
        if taken.isEmpty():
            return now.select("kind", "value", "surrogate")
        lost = F.col("_real").isNotNull() & (
            (F.col("_real") > 0) | (F.col("kind") != F.col("_kind")) | (F.col("value") != F.col("_value"))
        )
        again = now.join(taken, ["space", "surrogate"], "left").withColumn("lost", lost)
        if draw == draws - 1:
            settled = again.where(~F.col("lost")).select("kind", "value", "surrogate")
            return settled.unionByName(_changed_places(again.where("lost").select("kind", "value"), entities, key))
        now = again.withColumn("draw", F.col("draw") + F.col("lost").cast("int")).select("kind", "value", "space", "draw")


def _changed_places(left: DataFrame, entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate): the value that follows in a keyed order of the same format, the first after the last.

    The only one left of its format takes another value of it that is found in the texts.
    """
    shape = F.regexp_replace(F.regexp_replace("value", "[0-9]", "0"), r"\p{Ll}", "a")
    placed = materialize(
        left.withColumns(
            {"shape": shape, "at": F.concat_ws("|", F.sha2(F.concat_ws("|", F.lit(key), F.lit("places"), "kind", "value"), 256), "value")}
        )
    )
    follows = next_in_group(placed, ["kind", "shape"], "at", "after")
    first = placed.groupBy("kind", "shape").agg(F.min("at").alias("first"))
    ends = entities.groupBy("kind", shape.alias("shape")).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    taken = follows.join(first, ["kind", "shape"]).join(ends, ["kind", "shape"]).withColumn("from", F.coalesce("after", "first"))
    lone = F.when(F.col("low") != F.col("value"), F.col("low")).otherwise(F.col("high"))
    other = F.substring("from", F.lit(66), F.length("from"))
    return taken.select("kind", "value", F.when(F.col("from") == F.col("at"), lone).otherwise(other).alias("surrogate"))


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """docs with PII in `text` replaced, plus n_entities and pairs (kind, start) `replaced`.

    E-mail addresses, IPv4 addresses, IBANs, card numbers, phone numbers and titled
    names are entities. NULL text stays NULL; a text without entities is unchanged.
    Equal rows get equal texts; other columns pass through (`n_entities` replaces an
    equal name); an empty table gives no rows. The same key gives the same result.
    """
    docs, back = set_aside(docs.drop("n_entities"), INNER)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.withColumn("_has", text.rlike(ENTITY))
    with_any = marked.where("_has").drop("_has").withColumns(
        {"_hash": F.xxhash64("text"), "_found": F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))}
    )
    each = materialize(
        with_any.select("doc_id", "_hash", F.posexplode("_found").alias("at", "found"))
        .distinct()
        .withColumn("kind", kind_of(F.col("found")))
        .withColumn("kind", F.coalesce("kind", F.lit("phone")))
        .withColumn("value", normal(F.col("kind"), F.col("found")))
    )
    known = surrogates(each.select("kind", "value").distinct(), key)
    made = (
        each.join(known, ["kind", "value"])
        .groupBy("doc_id", "_hash")
        .agg(F.sort_array(F.collect_list(F.struct("at", rendered(F.col("kind"), F.col("found"), F.col("surrogate")).alias("new")))).alias("news"))
        .select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"), "news")
    )
    pieces = F.split(text, ENTITY, -1)
    joined = F.array_join(
        F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get("news", i)["new"], F.lit("")))), ""
    )
    replaced = (
        with_any.join(made, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")))
        .withColumns({"text": joined, "n_entities": F.size("news").cast("long")})
        .select(*back, "n_entities")
    )
    rest = marked.where(~F.col("_has")).withColumn("n_entities", F.lit(0).cast("long")).select(*back, "n_entities")
    return rest.unionByName(replaced)


def op5_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_pii(docs, "surrogates-1")
