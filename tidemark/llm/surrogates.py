"""PII surrogates: detected entities get keyed stand-ins of the same type and format.

1. One pattern finds mail addresses, IBANs, IPv4 addresses, social security numbers,
   card and phone numbers, and names after a form of address, which tells the gender.
2. Every distinct entity (kind and normal form) of the whole corpus gets a surrogate
   from a keyed hash: digits for digits, letters of the same script for letters, given
   names of the same gender. Equal entities get equal surrogates wherever and in
   whatever format they stand, so coreference holds.
3. Surrogates are checked: one that two entities share, or that is an entity itself, is
   drawn again with a higher attempt for all but the first, until all are distinct.
4. Only texts that hold entities move: they are cut at the matches and put together with
   the surrogates in the format of each place. A surname is also replaced where it
   stands alone with a capital in the same text.

A name is any number of parts and initials after one or more forms of address. An initial
gets another by a keyed order of its alphabet. The last part is the surname; a part in
small letters ('von') ends the name or keeps it from being found.

All steps are DataFrame functions, joins and grouped counts; an entity met in very many
texts is one row of the table of surrogates.

Defined cases: a null text stays null and holds nothing; rows that repeat get equal
results; very long texts are read whole; an empty table gives no rows; an input column
named ``entities`` is replaced, all others, whatever their names, are kept. A name has at
most ``MOST_FORMS`` forms of address (of more, the last ones) and ``MOST_PARTS`` parts;
capitalised words after those are no part of it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.rows import row_key
from tidemark.llm.text import let
from tidemark.session import Scratch

DEFAULT_KEY = "change-this-key"

# Forms of address by gender, and stand-in names by script and gender.
ADDRESS = {
    "m": ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Г-н", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Г-жа", "Госпожа", "Κυρία"),
    "n": ("Dr", "Prof"),
}
GIVEN = {
    ("latin", "m"): "Adam Boris Carl David Emil Felix Georg Hugo Ivan Jonas Karim Louis Marco Nils Oscar Paul".split(),
    ("latin", "f"): "Anna Berta Clara Diana Elena Flora Greta Hanna Irene Julia Karin Laura Maria Nina Olga Paula".split(),
    ("latin", "n"): "Alex Bobbie Charlie Dana Eden Frankie Gale Harper Indie Jules Kim Lou Morgan Noa Perry Robin".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита Олег Павел Роман Тимур".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Инна Кира Лидия Мария Нина Ольга Полина Рита Софья".split(),
    ("greek", "m"): "Άρης Βασίλης Γιώργος Δήμος Ευάγγελος Ζήσης Ηλίας Θάνος Ιάσων Κώστας Λεωνίδας Μάριος Νίκος Οδυσσέας Πέτρος Σταύρος".split(),
    ("greek", "f"): "Άννα Βάσω Γεωργία Δάφνη Ελένη Ζωή Ηρώ Θάλεια Ιωάννα Κατερίνα Λίνα Μαρία Νίκη Όλγα Πηνελόπη Σοφία".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do ka ke ko la le lo ma me mo na".split(),
    "cyrillic": "ба бе бо да де до ка ке ко ла ле ло ма ме мо на".split(),
    "greek": "βα βε βο δα δε δο κα κε κο λα λε λο μα με μο να".split(),
}
LETTERS = {"latin": "abcdefghijklmnop", "cyrillic": "абвгдежзиклмнопр", "greek": "αβγδεζηθικλμνξοπ"}
INITIALS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЭЮЯ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")

MOST_PARTS, MOST_FORMS = 8, 4  # parts of a name, initials before each not counted; forms of address before it

_WORD = r"[\p{L}\p{N}]"
_BEFORE = rf"(?<!{_WORD})"
_GAP = r"\h"  # any blank within a line, the no-break ones too
_FORM = "(?:" + "|".join(a for g in ADDRESS.values() for a in g) + ")"
_FORMS = rf"(?:{_FORM}\.?{_GAP}){{1,{MOST_FORMS}}}+"
# A name part has a capital and two letters at least, and runs to the last letter, over ', ’ and -
# but not over a possessive 's. Jr, II and the next form of address are no parts.
_LETTER = r"[\p{L}\p{M}]"
_JOIN = rf"(?:-|['’](?!s(?!{_LETTER})))"
_PART = (
    rf"(?!(?:{_FORM}|Jr|II|III|IV)(?!{_LETTER}))(?=\p{{Lu}}(?:{_LETTER}|{_JOIN}\p{{L}}))"
    rf"\p{{Lu}}{_LETTER}*+(?:{_JOIN}{_LETTER}++)*+"
)
_INITIALS = rf"(?:\p{{Lu}}\.(?:-?\p{{Lu}}\.){{0,3}}+{_GAP}?|\p{{Lu}}{_GAP}(?=\p{{Lu}})){{0,{MOST_PARTS}}}+"
_NAME = rf"{_INITIALS}{_PART}(?:{_GAP}{_INITIALS}{_PART}){{0,{MOST_PARTS - 1}}}+"
_TOKEN = rf"([^.{_GAP}]+\.?)({_GAP}?)"
PATTERNS = {
    "mail": rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}._%+-]++@[\p{{L}}\p{{N}}-][\p{{L}}\p{{N}}.-]*\.\p{{L}}{{2,}}",
    "iban": rf"{_BEFORE}[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?(?!{_WORD})",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)",
    "ssn": rf"{_BEFORE}\d{{3}}-\d{{2}}-\d{{4}}(?!{_WORD})",
    "card": rf"(?<![\p{{L}}\p{{N}}+])(?:\d{{4}}[ -]){{3}}\d{{4}}(?!{_WORD})|(?<![\p{{L}}\p{{N}}+])\d{{13,19}}(?!{_WORD})",
    "phone": (
        rf"(?<![\p{{L}}\p{{N}}+])\+1[ .-]?\(?\d{{3}}\)?[ .-]?\d{{3}}[ .-]?\d{{4}}(?!\d)"
        rf"|(?<![\p{{L}}\p{{N}}+])\+\d{{1,3}}[ .-]?\(?\d{{1,4}}\)?(?:[ .-]?\d{{2,4}}){{2,4}}(?!\d)"
        rf"|{_BEFORE}\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}}(?!\d)|{_BEFORE}\d{{3}}[ .-]\d{{3}}[ .-]\d{{4}}(?!\d)"
    ),
    "name": rf"{_BEFORE}{_FORMS}{_NAME}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# A part of whatever ANY matches: mail, numbers, short phone numbers, an IBAN of letters, names.
HINT = rf"[@]|\d[\d.() -]{{6}}|\+\d[\d.() -]{{5}}|[A-Z]{{2}}\d{{2}} ?[A-Z0-9]{{4}}|{_FORM}\.?{_GAP}"
DIGIT_KINDS = ("ssn", "card", "phone")


def found_in(text: Column) -> Column:
    """Entities of a text as written, in order; a cheap pattern spares most texts the full one."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)


def _kind(written: Column) -> Column:
    whole = F.coalesce(*[F.when(written.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()])
    return F.coalesce(whole, F.lit("phone"))


def _gender(written: Column) -> Column:
    pick = F.lit("n")
    for gender, forms in ADDRESS.items():
        pick = F.when(written.rlike(f"^(?:{'|'.join(forms)})\\.?{_GAP}"), gender).otherwise(pick)
    return pick


def _script(norm: Column) -> Column:
    return F.when(norm.rlike(r"\p{IsCyrillic}"), "cyrillic").when(norm.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _tokens(written: Column, group: int) -> Column:
    """Parts of a name without its forms of address (group 1) or the blank after each (group 2)."""
    return F.regexp_extract_all(F.regexp_replace(written, f"^{_FORMS}", ""), F.lit(_TOKEN), F.lit(group))


def _initial(key: str, token: Column) -> Column:
    """Another letter of the script for each capital, in a keyed order, so that no two fall together."""
    rings = [sorted(letters, key=lambda c: hashlib.sha256(f"{key}\u0001{c}".encode()).digest()) for letters in INITIALS]
    known = F.translate(token, "".join(map("".join, rings)), "".join("".join(r[1:] + r[:1]) for r in rings))
    return F.when(token.rlike(f"[{''.join(INITIALS)}]"), known).otherwise(F.regexp_replace(token, r"\p{Lu}", "X"))


def units(written: Column) -> Column:
    """array of (kind, norm): what of an entity is looked up. A name has its given names
    (by gender), initials and its surname, in order; all others are one unit."""
    kind = _kind(written)

    def unit(k: Column, n: Column) -> Column:
        return F.struct(k.alias("kind"), n.alias("norm"))

    given = F.concat(F.lit("given_"), _gender(written))
    name = let(_tokens(written, 1), lambda tokens: F.transform(tokens, lambda t, i: unit(
        F.when(t.rlike(r"^-?\p{Lu}\.?$"), "initial").when(i == F.size(tokens) - 1, "surname").otherwise(given),
        F.lower(F.translate(t, "’", "'")))))
    return (
        F.when(kind == "name", name)
        .when(kind.isin(*DIGIT_KINDS), F.array(unit(kind, F.regexp_replace(written, r"\D", ""))))
        .when(kind == "iban", F.array(unit(kind, F.regexp_replace(written, " ", ""))))
        .otherwise(F.array(unit(kind, F.lower(written))))
    )


def _hex(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """128 keyed hex digits."""
    part = lambda n: F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit(n), kind, norm, attempt.cast("string")), 256)
    return F.concat(part("0"), part("1"))


def _picks(pool: list[str], digits: Column) -> Column:
    """One entry of ``pool`` (16 long) per hex digit."""
    values = F.array(*[F.lit(p) for p in pool])
    return F.transform(F.split(digits, ""), lambda d: F.get(values, F.conv(d, 16, 10).cast("int")))


def _like(norm: Column, h: Column) -> Column:
    """Each digit and letter of ``norm`` replaced by the hash's next, script and all kept."""
    def one(c: Column, i: Column) -> Column:
        d = F.substring(h, i % 128 + 1, F.lit(1))
        letter = F.translate(d, "0123456789abcdef", LETTERS["latin"])
        for script, letters in LETTERS.items():
            letter = F.when(_script(c) == script, F.translate(d, "0123456789abcdef", letters)).otherwise(letter)
        letter = F.when(c == F.upper(c), F.upper(letter)).otherwise(letter)
        return F.when(c.rlike(r"^\d$"), F.translate(d, "abcdef", "345678")).when(c.rlike(r"^\p{L}$"), letter).otherwise(c)
    return F.array_join(F.transform(F.split(norm, ""), one), "")


def surrogate(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """A stand-in for ``norm`` in normal form. Card numbers that pass the check sum get
    one that does; a phone's country code stays; mail goes to a domain kept for examples."""
    h = _hex(key, kind, norm, attempt)
    script = _script(norm)

    def by_script(make) -> Column:
        out = make("latin")
        for other in ("cyrillic", "greek"):
            out = F.when(script == other, make(other)).otherwise(out)
        return out

    names = lambda pool: F.array_join(F.slice(_picks(pool, h), F.lit(1), attempt + 1), "-")
    given = F.when(kind == "given_n", names(GIVEN["latin", "n"]))
    for gender in ("m", "f"):
        given = F.when(kind == f"given_{gender}", by_script(lambda s, g=gender: names(GIVEN[s, g]))).otherwise(given)
    surname = by_script(lambda s: F.initcap(F.array_join(F.slice(_picks(SYLLABLES[s], h), F.lit(1), attempt + 4), "")))
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (
        F.conv(F.substring(h, i * 4 + 1, F.lit(4)), 16, 10).cast("int") % F.when(i == 0, 212).otherwise(256) + F.when(i == 0, 11).otherwise(0)))
    mail = F.concat(
        _like(F.regexp_replace(norm, "@.*$", ""), h), F.lit("@"),
        F.translate(F.substring(h, 65, 10), "0123456789abcdef", LETTERS["latin"]), F.lit(".example.net"),
    )
    digits = F.translate(F.substring(h, 1, 19), "abcdef", "345678")
    phone = F.concat(F.substring(norm, 1, 1), F.substr(F.translate(h, "abcdef", "345678"), F.lit(1), F.length(norm) - 1))
    card = let(F.struct(F.substr(digits, F.lit(1), F.length(norm) - 1).alias("d"), _luhn(norm).alias("ok")), lambda c: F.concat(
        c["d"], F.when(c["ok"] == 0, (10 - _luhn(F.concat(c["d"], F.lit("0")))) % 10).otherwise(
            (11 - _luhn(F.concat(c["d"], F.lit("0")))) % 10).cast("string")))
    iban = F.concat(F.substring(norm, 1, 2), _like(F.substring(norm, 3, 60), h))
    return (
        F.when(kind.startswith("given"), given).when(kind == "surname", surname).when(kind == "mail", mail)
        .when(kind == "ip", F.array_join(F.transform(octets, lambda o: o.cast("string")), "."))
        .when(kind == "phone", phone).when(kind == "card", card).when(kind == "iban", iban)
        .otherwise(F.substr(digits, F.lit(1), F.length(norm)))
    )


def _luhn(digits: Column) -> Column:
    """The card check sum modulo 10."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: let(
        c.cast("int") * (i % 2 + 1), lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10


def surrogate_table(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, norm, surrogate) for every distinct (kind, norm), all surrogates distinct."""
    made = surrogate(key, F.col("kind"), F.col("norm"), F.col("attempt"))
    table = scratch.put(entities.distinct().withColumn("attempt", F.lit(0)).withColumn("surrogate", made), "table0")
    step = 0
    while True:
        first = W.partitionBy("kind", "low").orderBy("attempt", "norm")
        real = entities.select("kind", F.col("norm").alias("low"), F.lit(True).alias("real")).distinct()
        checked = (
            table.withColumn("low", F.lower("surrogate")).withColumn("place", F.row_number().over(first))
            .join(real, ["kind", "low"], "left")
            .withColumn("clash", (F.col("place") > 1) | F.coalesce("real", F.lit(False)))
        )
        again = checked.select("kind", "norm", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"), "surrogate", "clash")
        step += 1
        done = scratch.put(
            again.select("kind", "norm", "attempt", F.when(F.col("clash"), made).otherwise(F.col("surrogate")).alias("surrogate"), "clash"),
            f"table{step}",
        )
        table = done.drop("clash")
        scratch.drop(f"table{step - 1}")
        if done.filter("clash").isEmpty():
            return table.select("kind", "norm", "surrogate")


def _in_format(written: Column, kind: Column, key: str, found: Column) -> Column:
    """``found`` surrogates of an entity's units in the format in which it is written."""
    one = F.get(found, F.lit(0))
    digits = F.aggregate(
        F.split(written, ""), F.struct(F.lit("").alias("text"), F.lit(0).alias("n")),
        lambda a, c: F.when(c.rlike(r"^\d$"), F.struct(
            F.concat(a["text"], F.substr(one, a["n"] + 1, F.lit(1))).alias("text"), (a["n"] + 1).alias("n")))
        .otherwise(F.struct(F.concat(a["text"], c).alias("text"), a["n"].alias("n"))),
        lambda a: a["text"],
    )
    gaps = _tokens(written, 2)
    parts = F.transform(_tokens(written, 1), lambda t, i: F.concat(
        F.when(F.get(found, i).isNull(), _initial(key, t)).when(t == F.upper(t), F.upper(F.get(found, i))).otherwise(F.get(found, i)),
        F.get(gaps, i)))
    name = F.concat(F.regexp_extract(written, f"^{_FORMS}", 0), F.array_join(parts, ""))
    spaced = F.aggregate(
        F.split(written, ""), F.struct(F.lit("").alias("text"), F.lit(0).alias("n")),
        lambda a, c: F.when(c == " ", F.struct(F.concat(a["text"], c).alias("text"), a["n"].alias("n"))).otherwise(
            F.struct(F.concat(a["text"], F.substr(one, a["n"] + 1, F.lit(1))).alias("text"), (a["n"] + 1).alias("n"))),
        lambda a: a["text"],
    )
    return (
        F.when(kind == "name", name).when(kind.isin(*DIGIT_KINDS), digits).when(kind == "iban", spaced)
        .when((kind == "mail") & (written == F.upper(written)) & (written != F.lower(written)), F.upper(one)).otherwise(one)
    )


def replace_entities(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with surrogates in ``text`` and ``entities``: array of (kind, surrogate),
    in order of the text. The originals are not returned."""
    scratch = Scratch(docs.sparkSession, "surrogates")
    kept = [c for c in docs.columns if c != "entities"]
    row = docs.select(*kept).select(F.struct("*").alias("_row"), "text", row_key(docs).alias("_key"))
    listed = row.withColumn("_found", found_in(F.coalesce("text", F.lit(""))))
    holds = scratch.put(
        listed.filter(F.size("_found") > 0)
        .withColumn("_units", F.transform("_found", lambda w: F.struct(w.alias("written"), _kind(w).alias("kind"), units(w).alias("units")))),
        "holds",
    )
    met = holds.select("_key", F.explode(F.array_distinct(F.flatten(F.col("_units.units")))).alias("u")).select("_key", "u.*").distinct()
    met = scratch.put(met.filter(F.col("kind") != "initial"), "met")
    table = surrogate_table(met.select("kind", "norm"), key, scratch)
    per_row = met.join(table, ["kind", "norm"]).groupBy("_key").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "kind", "norm"), "surrogate"))).alias("_map")
    )
    look = lambda u, m: F.element_at(m, F.concat_ws(":", u["kind"], u["norm"]))
    joined = holds.join(per_row, "_key")

    def put_together(u: Column, m: Column) -> Column:
        made = F.transform(u, lambda e: F.struct(
            e["kind"].alias("kind"),
            _in_format(e["written"], e["kind"], key, F.transform(e["units"], lambda x: look(x, m))).alias("surrogate")))
        alone = F.array_distinct(F.filter(F.flatten(u["units"]), lambda x: x["kind"] == "surname"))
        gaps = F.split(F.col("text"), ANY, -1)
        bare = let(alone, lambda names: F.transform(gaps, lambda g: F.when(F.size(names) == 0, g).otherwise(F.aggregate(
            names, g, lambda t, n: F.regexp_replace(
                t, F.concat(F.lit(r"(?<![\p{L}\p{N}])(?=\p{Lu})(?iu:\Q"), F.replace(n["norm"], F.lit("'"), F.lit(r"\E['’]\Q")),
                            F.lit(r"\E)(?![\p{L}\p{M}\p{N}])")), look(n, m))))))
        return let(F.struct(made.alias("made"), bare.alias("gaps")), lambda p: F.struct(
            F.array_join(F.transform(p["gaps"], lambda g, i: F.concat(g, F.coalesce(F.get(p["made"], i)["surrogate"], F.lit("")))), "").alias("text"),
            p["made"].alias("entities")))

    changed = joined.withColumn("_new", put_together(F.col("_units"), F.col("_map"))).select(
        *[F.col("_new.text").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in kept], F.col("_new.entities").alias("entities")
    )
    nothing = F.array().cast("array<struct<kind:string,surrogate:string>>")
    same = listed.filter(F.size("_found") == 0).select("_row.*", nothing.alias("entities"))
    return same.unionByName(changed)
