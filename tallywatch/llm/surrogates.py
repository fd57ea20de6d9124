"""Personal data replaced by surrogates: keyed, of the same type and format, one for each entity everywhere.

Entities are found by patterns and brought to a canonical form, so that ways to write one
entity count as one: e-mail addresses and secrets without case, telephone numbers as
their last ten digits, other numbers as their digits, names as their single parts.
Every distinct entity gets a surrogate from a keyed digest of its type and canonical form:

* e-mail: letters for letters of the same script, digits for digits, in a reserved domain;
* telephone, card, social security number: digits in the same places; a card keeps its
  first digit and, if it had one, a valid check digit;
* network address: four octets;  secret: hexadecimal digits, as many;
* name after a form of address: syllables in the same script, the ending by gender.

A surrogate that another entity already has, or that is itself an entity of the data, is
drawn again until there is none, so distinct entities stay distinct and no original
reappears. Occurrences take the surrogate in the entity's own layout and case.

Only column expressions are used. Texts without an entity never leave their task. The
others are merged to distinct texts before their entities are looked up, and lookups treat
frequent entities apart from the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.joins import join_frequent_apart
from tallywatch.llm.words import let
from tallywatch.sources.scratch import materialise

KEY = "surrogate-key-1"
MAX_ROUNDS = 50

#: Forms of address by gender.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа", "Κυρία"),
    "m": ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин", "Κύριος"),
    "n": ("Dr", "Prof"),
}
#: Syllables and the endings by gender and for surnames, by script.
SYLLABLES = {
    "latin": ("ba", "ke", "li", "mo", "ru", "sa", "te", "vi", "no", "da", "fe", "ga", "hi", "jo", "lu", "ma"),
    "cyrillic": ("ба", "ке", "ли", "мо", "ру", "са", "те", "ви", "но", "да", "фе", "га", "хи", "жо", "лу", "ма"),
    "greek": ("βα", "κε", "λι", "μο", "ρυ", "σα", "τε", "νι", "νο", "δα", "φε", "γα", "χι", "ζο", "λυ", "μα"),
}
ENDINGS = {
    "latin": {"given_f": "na", "given_m": "ren", "given_n": "ri", "surname": "ler"},
    "cyrillic": {"given_f": "на", "given_m": "рен", "given_n": "ри", "surname": "лер"},
    "greek": {"given_f": "να", "given_m": "ρων", "given_n": "ρι", "surname": "λης"},
}
SCRIPT_OF = (("cyrillic", r"\p{IsCyrillic}"), ("greek", r"\p{IsGreek}"))
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

_TITLE = "(?:" + "|".join(t for group in TITLES.values() for t in group) + ")"
_NAME = r"\p{Lu}[\p{L}’'-]+"
PATTERNS = {
    "email": r"[\p{L}\p{N}][\p{L}\p{N}._%+-]*@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "secret": r"(?<![\p{L}\p{N}])(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{32,64}(?![\p{L}\p{N}])",
    "address": r"(?<![\p{N}.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "phone": r"(?:(?<![\p{N}])\+?[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
             r"|(?<![\p{N}])(?:\+[0-9]{1,3}[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
             r"|(?<![\p{N}])\+[0-9]{10,13}(?![0-9])",
    "ssn": r"(?<![\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![\p{N}])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "name": rf"(?<![\p{{L}}]){_TITLE}\.? {_NAME}(?: {_NAME})?",
}
#: One pattern for all, in order of precedence, and a cheap one that every text with an entity matches.
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
MAYBE = rf"[0-9@]|{_TITLE}"
LAYOUT = ("phone", "ssn", "card")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _type_of(match: Column) -> Column:
    out = F.lit("name")
    for name in reversed(list(PATTERNS)[:-1]):
        out = F.when(match.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(out)
    return out


def _parts(match: Column) -> Column:
    """The entities in a match, in order: (type, canonical). Names have one or two, others one."""
    kind = _type_of(match)
    words = F.split(match, " ")
    title = F.regexp_replace(F.get(words, F.lit(0)), r"\.", "")
    gender = F.when(title.isin(*TITLES["f"]), "f").when(title.isin(*TITLES["m"]), "m").otherwise("n")
    entity = lambda t, c: F.struct(t.alias("type"), F.lower(c).alias("canonical"))
    given = entity(F.concat(F.lit("given_"), gender), F.get(words, F.lit(1)))
    surname = entity(F.lit("surname"), F.element_at(words, -1))
    names = F.when(F.size(words) > 2, F.array(given, surname)).otherwise(F.array(surname))
    digits = _digits(match)
    plain = F.when(kind == "phone", F.right(digits, F.lit(10))).when(kind.isin("ssn", "card"), digits).otherwise(match)
    return F.when(kind == "name", names).otherwise(F.array(entity(kind, plain)))


def _luhn(digits: Column) -> Column:
    """The sum that a valid card number has as a multiple of ten."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda d: d.cast("int"))
    doubled = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d)


def _draw(digest: Column, i: Column) -> Column:
    """The i-th number from 0 to 255 of a digest of 64 hexadecimal digits."""
    return (F.conv(F.substr(digest, (F.pmod(i, F.lit(32)) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int") + F.floor(i / 32).cast("int"))


def surrogate(kind: Column, canonical: Column, attempt: Column, key: str = KEY) -> Column:
    """The surrogate's canonical form at the given attempt."""
    digest = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, canonical, attempt.cast("string")), 256)

    def of(h: Column) -> Column:
        chars = F.split(canonical, "")
        number = F.array_join(F.transform(chars, lambda c, i: F.when(
            i.isin(0, 3) & (kind == "phone"), 2 + _draw(h, i) % 8).otherwise(_draw(h, i) % 10).cast("string")), "")
        kept = F.concat(F.left(canonical, F.lit(1)), F.substr(number, F.lit(2)))
        body = F.left(kept, F.length(kept) - 1)
        check = F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
        card = F.when(_luhn(canonical) % 10 == 0, F.concat(body, check)).otherwise(kept)
        octets = F.array_join(F.array(*[
            (1 + F.pmod(_draw(h, F.lit(2 * i)) * 256 + _draw(h, F.lit(2 * i + 1)), F.lit(223 if i == 0 else 254))).cast("string")
            for i in range(4)]), ".")
        alphabet = lambda c: F.when(c.rlike(SCRIPT_OF[0][1]), ALPHABETS["cyrillic"]).when(
            c.rlike(SCRIPT_OF[1][1]), ALPHABETS["greek"]).otherwise(ALPHABETS["latin"])
        letter = lambda c, i: F.substr(alphabet(c), F.pmod(_draw(h, i), F.length(alphabet(c))) + 1, F.lit(1))
        local = F.array_join(F.transform(F.split(F.substring_index(canonical, "@", 1), ""), lambda c, i: F.when(
            c.rlike(r"\p{N}"), (_draw(h, i) % 10).cast("string")).when(c.rlike(r"\p{L}"), letter(c, i)).otherwise(c)), "")
        host = F.array_join(F.transform(F.sequence(F.lit(20), F.lit(24) + attempt.cast("int")), lambda i: letter(F.lit("a"), i)), "")
        # Short local parts have few values of their own; a second try makes them longer.
        more = F.when(attempt > 0, F.substr(h, F.lit(50), attempt.cast("int"))).otherwise("")
        email = F.concat(local, more, F.lit("@"), host, F.lit(".example.org"))
        script = F.when(canonical.rlike(SCRIPT_OF[0][1]), "cyrillic").when(canonical.rlike(SCRIPT_OF[1][1]), "greek").otherwise("latin")

        def named(s: str) -> Column:
            pool = F.array(*[F.lit(x) for x in SYLLABLES[s]])
            stem = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2) + attempt.cast("int")), lambda i: F.get(
                pool, F.pmod(_draw(h, i), F.lit(len(SYLLABLES[s]))))), "")
            ending = F.lit(ENDINGS[s]["surname"])
            for t in ("given_f", "given_m", "given_n"):
                ending = F.when(kind == t, ENDINGS[s][t]).otherwise(ending)
            return F.concat(stem, ending)

        name = F.when(script == "cyrillic", named("cyrillic")).when(script == "greek", named("greek")).otherwise(named("latin"))
        return (
            F.when(kind == "email", email).when(kind == "address", octets).when(kind == "card", card)
            .when(kind.isin("phone", "ssn"), number).when(kind == "secret", F.left(h, F.length(canonical))).otherwise(name))

    return let(digest, of)


def assign_surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(type, canonical, n, surrogate) for distinct entities (type, canonical, n).

    In each round those whose surrogate is taken draw again: one that an entity of the same
    type has as canonical form, or that more than one entity drew, of which the one with
    the fewest attempts, then the smallest, keeps it.
    """
    drawn = materialise(entities.withColumn("attempt", F.lit(0)).withColumn(
        "surrogate", surrogate(F.col("type"), F.col("canonical"), F.lit(0), key)), "surrogates")
    originals = entities.select(F.col("type").alias("o_type"), F.col("canonical").alias("o_canonical"))
    for _ in range(MAX_ROUNDS):
        same = Window.partitionBy("type", "surrogate").orderBy("attempt", "canonical")
        checked = drawn.withColumn("_place", F.row_number().over(same)).join(
            originals, (F.col("type") == F.col("o_type")) & (F.col("surrogate") == F.col("o_canonical")), "left")
        checked = materialise(checked.withColumn("_again", (F.col("_place") > 1) | F.col("o_type").isNotNull()).drop(
            "_place", "o_type", "o_canonical"), "checked")
        if checked.where("_again").isEmpty():
            return checked.drop("_again", "attempt")
        later = F.col("attempt") + F.col("_again").cast("int")
        fresh = surrogate(F.col("type"), F.col("canonical"), F.col("later"), key)
        drawn = materialise(checked.withColumn("later", later).withColumn(
            "surrogate", F.when(F.col("_again"), fresh).otherwise(F.col("surrogate"))).select(
            "type", "canonical", "n", F.col("later").alias("attempt"), "surrogate"), "surrogates")
    raise RuntimeError("entities of one type have used up their surrogates")


def _written(match: Column, made: Column) -> Column:
    """The surrogates of a match's parts in its layout and case; ``made`` is (part, type, surrogate) in order."""
    kind, value = F.get(made, F.lit(0))["type"], F.get(made, F.lit(0))["surrogate"]
    skip = F.length(_digits(match)) - F.length(value)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("i"))
    filled = F.aggregate(
        F.split(match, ""), start,
        lambda a, c: F.when(c.rlike("[0-9]"), F.struct(
            F.concat(a["out"], F.when(a["i"] < skip, c).otherwise(F.substr(value, a["i"] - skip + 1, F.lit(1)))).alias("out"),
            (a["i"] + 1).alias("i"))).otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["i"].alias("i"))),
        lambda a: a["out"])
    shouted = (F.upper(match) == match) & (F.lower(match) != match)
    cased = F.when(shouted, F.upper(value)).otherwise(value)
    words = F.split(match, " ")
    name = F.concat_ws(" ", F.get(words, F.lit(0)), F.array_join(F.transform(made, lambda m: F.initcap(m["surrogate"])), " "))
    return F.when(kind.isin(*LAYOUT), filled).when(kind.isin("email", "secret", "address"), cased).otherwise(name)


def replace_entities(docs: DataFrame, text_col: str = "text", count_col: str = "n_entities", key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text_col`` and the number of replaced matches in ``count_col``.

    Null texts stay null, empty ones empty, with 0 matches. Texts without an entity are
    returned unchanged. Equal texts, repeated rows among them, get equal results. A
    column named ``count_col`` is replaced; other columns are kept. An empty table gives
    no rows.
    """
    text = F.col(text_col)
    columns = [c for c in docs.columns if c != count_col]
    found = F.when(text.rlike(MAYBE), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    # The rows travel as one column, so that no name of theirs can clash.
    marked = docs.select(F.struct(*columns).alias("doc"), F.coalesce(found, F.array().cast("array<string>")).alias("_matches"))
    text = F.col("doc")[text_col]
    # A text is known by two hashes, its length and its matches' number.
    ident = [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), F.reverse(text)).alias("_h2"), F.length(text).alias("_len")]
    keys = ["_h1", "_h2", "_len"]
    held = marked.where(F.size("_matches") > 0)
    texts = materialise(held.select(*ident, "_matches").groupBy(*keys).agg(F.first("_matches").alias("_matches")), "entity-texts")
    each = texts.select(*keys, F.posexplode("_matches").alias("at", "match"))
    each = each.select(*keys, "at", "match", F.posexplode(_parts(F.col("match"))).alias("part", "e")).select(
        *keys, "at", "match", "part", "e.*")
    each = materialise(each, "occurrences")
    entities = materialise(each.groupBy("type", "canonical").agg(F.count("*").alias("n")), "entities")
    total = each.count()
    mapped = join_frequent_apart(each, assign_surrogates(entities, key), ["type", "canonical"], "n", total)
    made = mapped.groupBy(*keys, "at", "match").agg(
        F.sort_array(F.collect_list(F.struct("part", "type", "surrogate"))).alias("made"))
    lists = made.select(*keys, "at", _written(F.col("match"), F.col("made")).alias("new")).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("at", "new")))["new"].alias("_new"))
    between = F.split(text, ANY, -1)
    rebuilt = F.array_join(F.zip_with(between, F.col("_new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = held.select("*", *ident).join(lists, keys).select(
        *[(rebuilt if c == text_col else F.col("doc")[c]).alias(c) for c in columns], F.size("_matches").alias(count_col))
    same = marked.where(F.size("_matches") == 0).select("doc.*", F.lit(0).alias(count_col))
    return same.unionByName(changed)
