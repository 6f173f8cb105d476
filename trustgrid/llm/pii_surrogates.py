"""Surrogates for personal data, with DataFrame functions only.

Found in every whole text: e-mail addresses, IPv4 addresses, card numbers (13 to 19 digits), phone numbers, social
security numbers, IBANs and names after a form of address. Each distinct entity gets a surrogate drawn with a keyed
hash: letters stay letters of the same case and script, digits stay digits, separators and the mention's own layout
stay; a phone number keeps its country code, an IBAN its country; a card number that passes the Luhn check and an IBAN that
passes modulo 97 get surrogates that pass it; octets stay octets; names keep their form of address and get names of the
same gender and script. Mentions of one entity (same normal form, whatever the layout) get the same surrogate everywhere.

Collision check: a draw that equals another entity's draw, or an entity that occurs in the corpus, is drawn again
with the next attempt until none collides, so distinct entities stay distinct and no surrogate is a real value of
the corpus. Every further draw of a name has one more syllable, so its space grows sixteenfold and names do not run out.
Entities that still collide after ``ATTEMPTS`` draws (a format whose values are used up) become numbered tags.

Null texts stay null, empty texts empty; repeated rows get equal results; extra columns pass through. Texts are not
shuffled unless a document holds an entity that was drawn again; then its attempts are joined to it by id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

ATTEMPTS = 6

# Forms of address by gender (fixed values): Latin, Cyrillic, Greek.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Κυρία")

GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Noah Oscar Paul".split(),
    ("f", "latin"): "Alma Berta Clara Dora Emma Flora Greta Helen Ida Julia Klara Lena Maria Nora Olga Paula".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Захар Игорь Кирилл Леонид Максим Никита Олег Павел".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Марина Нина Ольга Полина".split(),
    ("m", "greek"): "Αλέξης Βασίλης Γιώργος Δημήτρης Ηλίας Θωμάς Κώστας Λευτέρης Μιχάλης Νίκος Πέτρος Σπύρος".split(),
    ("f", "greek"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη Σοφία Χριστίνα".split(),
}
SYLLABLES = {
    "latin": "bar den fel gor han jun kal lim mor nas pel ros sil tam ver wen".split(),
    "cyrillic": "бар ден фел гор хан жун кал лим мор нас пел рос сил там вер зен".split(),
    "greek": "βαρ δεν φελ γορ χαν ζον καλ λιμ μορ νασ πελ ροσ σιλ ταμ βερ ζεν".split(),
}

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
IP = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
CARD = r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"
PHONE = (r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
         r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"
         r"|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])")
NAME = (r"(?<!\p{L})(?:" + "|".join(MALE + FEMALE) + r")\.?\x20\p{Lu}\p{L}{1,30}(?:[ -]\p{Lu}\p{L}{1,30}){0,2}")
# country calling codes by the numbering plan, so that they show without a separator: 1 and 7, those of two digits, else three
COUNTRY = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
ANY = "|".join((EMAIL, IP, SSN, IBAN, CARD, PHONE, NAME))


def kind_of(mention: Column) -> Column:
    """Type of a mention, from its own form."""
    whole = lambda p: mention.rlike(f"^(?:{p})$")
    return (F.when(mention.contains("@"), "email").when(whole(IP), "ip").when(whole(SSN), "ssn")
            .when(whole(IBAN), "iban").when(whole(CARD), "card").when(mention.rlike(r"^[\d+(]"), "phone")
            .otherwise("name"))


def normal_form(mention: Column, kind: Column) -> Column:
    """What makes two mentions the same entity."""
    gender = F.when(mention.rlike("^(?:" + "|".join(FEMALE) + r")\.?\x20"), "f").otherwise("m")
    names = F.regexp_replace(mention, r"^\S+\x20", "")
    return (F.when(kind.isin("email"), F.lower(mention))
            .when(kind.isin("card", "ssn", "phone"), F.regexp_replace(mention, r"[^\d+]", ""))
            .when(kind == "iban", F.regexp_replace(mention, " ", ""))
            .when(kind == "name", F.concat(gender, F.lit(":"), F.lower(names))).otherwise(mention))


def _digest(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), norm).cast("binary"), 256)


def _byte(digest: Column, i: Column) -> Column:
    """The i-th byte of a hex digest, round and round, shifted a little each round."""
    at = F.pmod(i, F.lit(32)).cast("int")
    value = F.conv(F.substr(digest, at * 2 + 1, F.lit(2)), 16, 10).cast("int")
    return value + (i / 32).cast("int") * 7


def _redrawn(text: Column, digest: Column, kept: Column, to: Column) -> Column:
    """Letters and digits after the first ``kept``, up to place ``to``, replaced by others of their class; the n-th by
    the n-th byte, wherever separators stand."""
    plain = F.regexp_replace

    def one(i: Column) -> Column:
        c = F.substr(text, i, F.lit(1))
        nth = F.length(plain(F.substr(text, F.lit(1), i), r"[^A-Za-z0-9]", ""))
        b = _byte(digest, nth)
        new = (F.when(c.rlike(r"\d"), F.substr(F.lit("0123456789"), F.pmod(b, F.lit(10)) + 1, F.lit(1)))
               .when(c.rlike("[a-z]"), F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), F.pmod(b, F.lit(26)) + 1, F.lit(1)))
               .when(c.rlike("[A-Z]"), F.substr(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.pmod(b, F.lit(26)) + 1, F.lit(1)))
               .otherwise(c))
        return F.when((nth > kept) & (i <= to), new).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a text of digits, the last one taken plainly, modulo 10."""
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int") * (i % 2 + 1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.pmod(F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add), F.lit(10))


def _modulo_97(iban: Column) -> Column:
    """The number an IBAN without blanks stands for, its first four places at the end, modulo 97."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        c = F.substr(turned, i, F.lit(1))
        value = F.when(c.rlike(r"\d"), rest * 10 + c.try_cast("int")).otherwise(rest * 100 + F.ascii(c) - 55)
        return F.pmod(value, F.lit(97))

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add)


def _checked(mention: Column, kind: Column, drawn: Column) -> Column:
    """``drawn`` with a check digit (the last one of a card number) or check digits (places 3 and 4 of an IBAN) that hold,
    if those of the mention do."""
    digits = lambda c: F.regexp_replace(c, r"\D", "")
    most = F.substr(drawn, F.lit(1), F.length(drawn) - 1)
    card = F.concat(most, F.pmod(10 - _luhn(F.concat(digits(most), F.lit("0"))), F.lit(10)).cast("string"))
    open_ = F.concat(F.substr(drawn, F.lit(1), F.lit(2)), F.lit("00"), F.substr(drawn, F.lit(5)))
    iban = F.concat(F.substr(drawn, F.lit(1), F.lit(2)),
                    F.lpad((98 - _modulo_97(F.regexp_replace(open_, " ", ""))).cast("string"), 2, "0"), F.substr(drawn, F.lit(5)))
    return (F.when((kind == "card") & (_luhn(digits(mention)) == 0), card)
            .when((kind == "iban") & (_modulo_97(F.regexp_replace(mention, " ", "")) == 1), iban).otherwise(drawn))


def _name(mention: Column, norm: Column, digest: Column, attempt: Column) -> Column:
    """Form of address kept; a given name of its gender and script if there was one, and a family name."""
    script = (F.when(mention.rlike(r"\p{IsCyrillic}"), "cyrillic").when(mention.rlike(r"\p{IsGreek}"), "greek")
              .otherwise("latin"))
    gender = F.substr(norm, F.lit(1), F.lit(1))
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), F.pmod(_byte(digest, F.lit(i)), F.lit(len(values))) + 1)  # noqa: E731,E501
    given = reduce(lambda c, kv: c.when((gender == kv[0][0]) & (script == kv[0][1]), pick(kv[1], 0)), GIVEN.items(), F)
    family = reduce(lambda c, kv: c.when(script == kv[0], F.concat(
        *[pick(kv[1], i) for i in (1, 2, 3, 4)],
        *[F.when(attempt > i, pick(kv[1], 5 + i)).otherwise("") for i in range(ATTEMPTS - 1)])), SYLLABLES.items(), F)
    family = F.concat(F.upper(F.substr(family, F.lit(1), F.lit(1))), F.substr(family, F.lit(2)))
    many = norm.rlike(r"[ -]")
    address = F.regexp_extract(mention, r"^\S+\x20", 0)
    return F.concat(address, F.when(many, F.concat(given, F.lit(" "))).otherwise(""), family)


def surrogate(mention: Column, kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The replacement of a mention: same type, layout, letter case, gender and script."""
    digest = _digest(key, kind, norm, attempt)
    size = F.length(mention)
    top_level = F.length(F.regexp_extract(mention, r"\.[A-Za-z]+$", 0))
    country = F.greatest(F.length(F.regexp_extract(norm, COUNTRY, 0)) - 1, F.lit(0))      # of the entity, not the layout
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)),
                                      lambda i: (F.pmod(_byte(digest, i), F.lit(254)) + 1).cast("string")), ".")
    drawn = (F.when(kind == "ip", octets).when(kind == "name", _name(mention, norm, digest, attempt))
             .when(kind.isin("card", "iban"), _checked(mention, kind, _redrawn(
                 mention, digest, F.when(kind == "iban", F.lit(4)).otherwise(F.lit(0)), size)))
             .otherwise(_redrawn(mention, digest, F.when(kind == "phone", country).otherwise(F.lit(0)),
                                 F.when(kind == "email", size - top_level).otherwise(size))))
    tag = F.concat(F.lit("["), F.upper(kind), F.lit("-"), F.substr(digest, F.lit(1), F.lit(16)), F.lit("]"))
    return F.when(attempt >= ATTEMPTS, tag).otherwise(drawn)


def mentions(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def redrawn_entities(entities: DataFrame, key: str) -> DataFrame | None:
    """(kind, norm, attempt) of entities whose first draw collided; None if there is none.

    ``entities`` has one row per distinct (kind, norm) with one ``mention`` of it. Each round draws for the entities
    still open and keeps those draws that no entity and no other draw has.
    """
    # the normal form of a draw: what it would be taken for when read again
    def drawn(df: DataFrame) -> DataFrame:
        new = surrogate(F.col("mention"), F.col("kind"), F.col("norm"), F.col("attempt"), key)
        return df.withColumn("new", normal_form(new, F.col("kind")))

    real = entities.select("kind", F.col("norm").alias("new"), F.lit(1).alias("is_real"))
    settled = saved(drawn(entities.withColumn("attempt", F.lit(0))), "draw")
    for attempt in range(1, ATTEMPTS + 1):
        order = Window.partitionBy("kind", "new").orderBy("attempt", "norm")
        checked = (settled.withColumn("nth", F.row_number().over(order)).join(real, ["kind", "new"], "left")
                   .withColumn("again", ((F.col("nth") > 1) | F.col("is_real").isNotNull())
                               & (F.col("attempt") < ATTEMPTS)).drop("nth", "is_real"))
        if not checked.filter("again").limit(1).count():
            break
        settled = saved(checked.filter(~F.col("again")).drop("again").unionByName(
            drawn(checked.filter("again").drop("again", "new").withColumn("attempt", F.lit(attempt)))
            .select(*settled.columns)), "draw")
    again = settled.filter(F.col("attempt") > 0).select("kind", "norm", "attempt")
    return again if again.limit(1).count() else None


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text",
                out_col: str = "clean_text") -> DataFrame:
    """``docs`` with ``out_col`` and ``entities``: array of (kind, mention, surrogate) in order of the text."""
    held = docs.withColumn("_mentions", mentions(F.col(text_col)))
    kind, norm = kind_of(F.col("mention")), normal_form(F.col("mention"), F.col("kind"))
    entities = saved(held.select(F.col(id_col).alias("_id"), F.explode("_mentions").alias("mention"))
                     .withColumn("kind", kind).withColumn("norm", norm)
                     .groupBy("_id", "kind", "norm").agg(F.min("mention").alias("mention")), "mentions")
    again = redrawn_entities(entities.groupBy("kind", "norm").agg(F.min("mention").alias("mention")), key)
    attempts = None
    if again is not None:
        attempts = (entities.join(again, ["kind", "norm"])
                    .groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct(
                        F.concat_ws("|", "kind", "norm"), F.col("attempt")))).alias("_attempts")))
        held = held.join(attempts, F.col(id_col).eqNullSafe(F.col("_id")), "left").drop("_id")
    else:
        held = held.withColumn("_attempts", F.lit(None).cast("map<string,int>"))

    def entity(m: Column) -> Column:
        typed = F.transform(F.array(m), lambda x: F.struct(x.alias("mention"), kind_of(x).alias("kind")))
        normed = F.transform(typed, lambda x: F.struct(x["mention"].alias("mention"), x["kind"].alias("kind"),
                                                       normal_form(x["mention"], x["kind"]).alias("norm")))
        return F.element_at(F.transform(normed, lambda x: F.struct(
            x["kind"].alias("kind"), x["mention"].alias("mention"),
            surrogate(x["mention"], x["kind"], x["norm"], F.coalesce(
                F.element_at(F.col("_attempts"), F.concat_ws("|", x["kind"], x["norm"])), F.lit(0)), key)
            .alias("surrogate"))), 1)

    held = held.withColumn("entities", F.transform("_mentions", entity))
    between = F.split(F.col(text_col), ANY, -1)
    replaced = F.concat(F.transform("entities", lambda e: e["surrogate"]), F.array(F.lit("")))
    clean = F.when(F.size("entities") == 0, F.col(text_col)).otherwise(
        F.array_join(F.zip_with(between, replaced, lambda a, b: F.concat(a, b)), ""))
    return held.withColumn(out_col, clean).drop("_mentions", "_attempts")


KEY = "surrogate-key-1"


def op3_pii_surrogates(docs: DataFrame) -> DataFrame:
    """Every document's text with surrogates, and how many entities of each kind it held."""
    out = replace_pii(docs.select("doc_id", "text"), KEY)
    n = lambda k: F.size(F.filter("entities", lambda e: e["kind"] == k)).alias(f"n_{k}")
    return out.select("doc_id", F.col("clean_text").alias("text"), F.size("entities").alias("n_entities"),
                      *[n(k) for k in ("email", "ip", "ssn", "iban", "card", "phone", "name")])
