"""Personal data replaced by keyed surrogates of the same type, with DataFrame functions only.

An entity's surrogate depends on a secret key and the entity's normal form, so that one entity gets
the same surrogate everywhere. Surrogates keep type, format (punctuation, letter case, number of
digits, check digit), script, and the gender of names. Different entities never share a surrogate,
and no surrogate is an entity that occurs in the texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import stored

# Titles, and given names by gender and script.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа")
OTHER_TITLES = ("Dr", "Prof")
GIVEN = {
    ("latin", "male"): "Adam Bruno Carl Dario Emil Felix Gustav Hugo Ivan Jonas Karl Leon Marco Nils Oscar Paul",
    ("latin", "female"): "Anna Berta Clara Dora Emma Flora Greta Helena Irma Julia Karla Laura Marta Nora Olga Paula",
    ("cyrillic", "male"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел",
    ("cyrillic", "female"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Лидия Мария Ольга Полина",
}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя",
           "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
SYLLABLES = {"latin": "ba be bo da de do ka ke ko la le lo ma mi na no".split(),
             "cyrillic": "ба бе бо да де до ка ке ко ла ле ло ма ми на но".split()}

_TITLE = "(?:" + "|".join(sorted(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES, key=lambda t: -len(t))) + r")\.? "
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_SECRET = r"(?i:password|passwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"

#: What is looked for, in this order at each place. All start where no letter or digit stands in
#: front, so that the inside of a word costs one test. No part backtracks over long runs: repeated
#: classes are possessive or bounded.
PATTERNS = {
    "email": r"(?<![._%+-])[\p{L}\d._%+-]++@[\p{L}\d-]{1,63}+(?:\.[\p{L}\d-]{1,63}+){1,8}",
    "secret": _SECRET + r"[A-Za-z\d_+/-]{8,}+",
    "access_key": r"(?:AKIA|ASIA)[A-Z\d]{16}(?![A-Z\d])",
    "ip": rf"(?<!\.){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)",
    "ssn": r"(?<!-)\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<!\+)(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<!\+)\+\d{9,14}(?!\d)",
    "card": r"(?<!\.)\d(?:[ -]?\d){12,18}(?!\d)",
    "name": rf"{_TITLE}\p{{Lu}}\p{{L}}{{1,40}}+(?:[ -]\p{{Lu}}\p{{L}}{{1,40}}+){{0,2}}",
}
_NUMBERS = ("ip", "ssn", "phone", "card")
ANY = (r"(?<![\p{L}\d])(?:" + "|".join(p for k, p in PATTERNS.items() if k not in _NUMBERS)
       + r"|(?=[\d+(])(?:" + "|".join(PATTERNS[k] for k in _NUMBERS) + "))")
#: Kinds whose surrogate grows by a part at each further attempt, so that it always finds room.
GROWING = ("email", "secret", "access_key", "name", "given")
ATTEMPTS = 40


def _in(*values: str) -> list[Column]:
    return [F.lit(v) for v in values]


def _kind(surface: Column) -> Column:
    kind = F.lit("name")
    for name, pattern in reversed(list(PATTERNS.items())):
        kind = F.when(surface.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def described(surfaces: DataFrame) -> DataFrame:
    """kind, kept (what stays in front), body and normal (what tells entities apart)."""
    kind, s = F.col("kind"), F.col("surface")
    digits = F.regexp_replace(s, r"\D", "")
    kept = (F.when(kind == "secret", F.regexp_extract(s, f"^{_SECRET}", 0))
            .when(kind == "access_key", F.substring(s, 1, 4))
            .when(kind == "name", F.regexp_extract(s, f"^{_TITLE}", 0)).otherwise(""))
    body = F.expr("substr(surface, length(kept) + 1)")
    normal = (F.when(kind == "email", F.lower(s)).when(kind == "phone", F.expr("right(digits, 10)"))
              .when(kind.isin("card", "ssn"), F.col("digits"))
              .when(kind == "name", F.lower(F.regexp_extract("body", r"\p{L}+$", 0))).otherwise(F.col("body")))
    return (surfaces.withColumn("kind", _kind(s)).withColumn("kept", kept).withColumn("digits", digits)
            .withColumn("body", body).withColumn("normal", normal))


def _stream(key: str, salt: Column, chars: Column) -> Column:
    """Two hexadecimal digits, from a keyed digest, for each of ``chars`` characters."""
    blocks = F.sequence(F.lit(0), F.floor(chars / 32).cast("int"))
    return F.array_join(F.transform(blocks, lambda b: F.sha2(
        F.concat_ws("\x1f", F.lit(key), F.col("kind"), salt, b.cast("string"), F.lit(key)), 256)), "")


def _byte(stream: Column, i: Column) -> Column:
    """Number ``i`` (from 1) of a stream, 0 to 255."""
    return F.conv(F.substring(stream, (2 * i - 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), (n % len(letters) + 1).cast("int"), F.lit(1))


def _same_class(text: Column, stream: Column) -> Column:
    """Each digit for a digit, each letter for one of its script and case; the rest stays."""
    hexadecimal = text.rlike("^[0-9a-f]+$")

    def one(i: Column) -> Column:
        c, n = F.substring(text, i.cast("int"), F.lit(1)), _byte(stream, i)
        letter = (F.when(c.rlike(r"\p{IsCyrillic}"), _pick(LETTERS["cyrillic"], n))
                  .when(c.rlike(r"\p{IsGreek}"), _pick(LETTERS["greek"], n))
                  .when(hexadecimal, _pick("abcdef", n)).otherwise(_pick(LETTERS["latin"], n)))
        return (F.when(c.rlike(r"\d"), (n % 10).cast("string"))
                .when(c.rlike(r"\p{Lu}"), F.upper(letter)).when(c.rlike(r"\p{L}"), letter).otherwise(c))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")


def _digit(text: Column, i: Column) -> Column:
    return F.substring(text, i.cast("int"), F.lit(1)).cast("int")


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits with every second one from the right doubled; 0 mod 10 if valid."""
    def one(i: Column) -> Column:
        d = _digit(digits, F.length(digits) - i + 1)
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), one), F.lit(0), lambda a, b: a + b)


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _surname(normal: Column, stream: Column, attempt: Column) -> Column:
    def built(script: str) -> Column:
        parts = F.array(*_in(*SYLLABLES[script]))
        return F.array_join(F.transform(F.sequence(F.lit(1), attempt + 4), lambda i: F.element_at(
            parts, _byte(stream, i) % len(SYLLABLES[script]) + 1)), "")

    return F.when(_script(normal) == "cyrillic", built("cyrillic")).otherwise(built("latin"))


def _given(normal: Column, stream: Column, attempt: Column) -> Column:
    """A listed given name of the form's script and gender, with a syllable for each further attempt."""
    script, gender = F.get(F.split(normal, "\x1f"), 0), F.get(F.split(normal, "\x1f"), 1)

    def grown(script: str) -> Column:
        parts = F.array(*_in(*SYLLABLES[script]))
        return F.array_join(F.transform(F.sequence(F.lit(1), attempt), lambda i: F.element_at(
            parts, _byte(stream, i + 2) % len(SYLLABLES[script]) + 1)), "")

    draw, out = 256 * _byte(stream, F.lit(1)) + _byte(stream, F.lit(2)), F.lit(None).cast("string")
    for s in SYLLABLES:
        male, female = GIVEN[s, "male"].lower().split(), GIVEN[s, "female"].lower().split()
        more = F.when(attempt > 0, grown(s)).otherwise("")
        for kind, listed in (("male", male), ("female", female), ("any", male + female)):
            name = F.element_at(F.array(*_in(*listed)), draw % len(listed) + 1)
            out = F.when((script == s) & (gender == kind), F.concat(name, more)).otherwise(out)
    return out


def candidates(normals: DataFrame, key: str) -> DataFrame:
    """kind, normal, attempt -> with ``core``: the surrogate's normal form at that attempt."""
    kind, normal, attempt = F.col("kind"), F.col("normal"), F.col("attempt")
    stream = _stream(key, F.concat_ws("\x1f", normal, attempt.cast("string")), F.length(normal) + 2 * ATTEMPTS)
    s = F.col("stream")
    same = _same_class(normal, s)
    extra = F.array_join(F.transform(F.sequence(F.lit(1), attempt), lambda i: (_byte(s, F.length(normal) + i) % 10).cast("string")), "")
    grown = F.when(attempt > 0, extra).otherwise("")
    octets = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (1 + _byte(s, i) % 254).cast("string")), ".")
    card = F.concat(F.substring(normal, 1, 1), F.expr("substr(same, 2)"))
    without = F.concat(F.expr("left(card, length(card) - 1)"), F.lit("0"))
    checked = F.when(luhn_sum(normal) % 10 == 0, F.concat(
        F.expr("left(card, length(card) - 1)"), ((10 - luhn_sum(without) % 10) % 10).cast("string"))).otherwise(F.col("card"))
    core = (F.when(kind == "email", F.concat(grown, F.expr("concat(left(same, length(same) - length(tld)), tld)")))
            .when(kind == "ip", octets).when(kind == "card", checked)
            .when(kind == "name", _surname(normal, s, attempt)).when(kind == "given", _given(normal, s, attempt))
            .when(kind.isin("secret", "access_key"), F.concat(F.col("same"), grown)).otherwise(F.col("same")))
    return (normals.withColumn("stream", stream).withColumn("same", same)
            .withColumn("tld", F.regexp_extract("normal", r"\.[^.]*$", 0)).withColumn("card", card)
            .withColumn("core", core).select("kind", "normal", "attempt", "core"))


def assigned(normals: DataFrame, key: str) -> DataFrame:
    """kind, normal, core: each distinct normal form with a surrogate of its own.

    A candidate that several want goes to the smallest of them; one that occurs as an entity goes
    to nobody. The others try again, with longer surrogates where the kind allows; as long as any
    is left. A kind without room for all of its entities is an error, not a shared surrogate.
    """
    # A given name is one, whatever script and gender stand in front of it.
    real = normals.select("kind", F.when(F.col("kind") == "given", F.element_at(F.split("normal", "\x1f"), -1))
                          .otherwise(F.col("normal")).alias("core")).distinct()
    done, left = None, normals.withColumn("attempt", F.lit(0))
    for attempt in range(ATTEMPTS):
        tried = stored(candidates(left, key))
        free = tried.join(real, ["kind", "core"], "left_anti")
        if done is not None:
            free = free.join(done, ["kind", "core"], "left_anti")
        won = free.groupBy("kind", "core").agg(F.min("normal").alias("normal"))
        won = stored(won if done is None else done.unionByName(won))
        left = stored(tried.join(won, ["kind", "normal"], "left_anti").select(
            "kind", "normal", F.lit(attempt + 1).alias("attempt")))
        if left.isEmpty():
            return won
        done = won
    raise ValueError("more entities of a kind than surrogates for it")


def _filled(body: Column, digits: Column) -> Column:
    """``body`` with its digits replaced by ``digits`` in order, from the right."""
    def one(i: Column) -> Column:
        c = F.substring(body, i.cast("int"), F.lit(1))
        behind = F.length(F.regexp_replace(F.substring(body, i.cast("int"), F.length(body)), r"\D", ""))
        at = F.length(digits) - behind + 1
        return F.when(c.rlike(r"\d") & (at > 0), F.substring(digits, at.cast("int"), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(body)), one), "")


def _given_forms() -> Column:
    """Script, gender and lower-cased form of each given name in a name's body, in order."""
    title = F.regexp_replace("kept", r"[. ]+$", "")
    words = F.expr("slice(split(body, '[ -]'), 1, size(split(body, '[ -]')) - 1)")

    def one(word: Column) -> Column:
        gender = F.when(title.isin(*MALE_TITLES), "male").when(title.isin(*FEMALE_TITLES), "female")
        for (script, known), listed in GIVEN.items():
            gender = gender.when((_script(word) == script) & F.array_contains(F.array(*_in(*listed.split())), word), known)
        return F.concat_ws("\x1f", _script(word), gender.otherwise("any"), F.lower(word))

    return F.transform(words, one)


def _cased(core: Column, like: Column) -> Column:
    return F.when(like == F.upper(like), F.upper(core)).otherwise(core)


def rendered() -> Column:
    """The surrogate of a surface form in that form's format. ``given`` has its new given names."""
    kind = F.col("kind")
    surname = F.regexp_extract("body", r"\p{L}+$", 0)
    first = F.array_join(F.transform("given", lambda g: F.concat(F.initcap(g), F.lit(" "))), "")
    name = F.concat(first, F.when((surname == F.upper(surname)) & (F.length(surname) > 1), F.upper("core")).otherwise(F.initcap("core")))
    return F.concat("kept", F.when(kind.isin("phone", "card", "ssn"), _filled(F.col("body"), F.col("core")))
                    .when(kind == "name", name).when(kind == "email", _cased(F.col("core"), F.col("body")))
                    .otherwise(F.col("core")))


def surrogates(surfaces: DataFrame, key: str) -> DataFrame:
    """kind, surface, surrogate for a table of distinct surface forms."""
    forms = F.when(F.col("kind") == "name", _given_forms()).otherwise(F.array().cast("array<string>"))
    known = stored(described(surfaces).withColumn("forms", forms))
    each = known.select("surface", F.posexplode("forms").alias("at", "normal")).withColumn("kind", F.lit("given"))
    cores = assigned(known.select("kind", "normal").unionByName(each.select("kind", "normal")).distinct(), key)
    given = (each.join(cores, ["kind", "normal"]).groupBy("surface")
             .agg(F.array_sort(F.collect_list(F.struct("at", "core"))).alias("g")).select("surface", F.col("g.core").alias("given")))
    whole = known.join(cores, ["kind", "normal"]).join(given, "surface", "left")
    return (whole.withColumn("given", F.coalesce("given", F.array().cast("array<string>")))
            .select("kind", "surface", rendered().alias("surrogate")))


def replaced(text: Column, found: Column) -> Column:
    """``text`` with its entities replaced by the elements of ``found`` in order."""
    between = F.split(text, ANY, -1)
    return F.array_join(F.transform(between, lambda part, i: F.concat(part, F.coalesce(F.get(found, i), F.lit("")))), "")


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text", count: str | None = None,
                  n_chars: str | None = None) -> DataFrame:
    """``docs`` with every entity in ``text_col`` replaced by its surrogate.

    All other columns, and rows without an entity, stay as they are; null texts stay null. With
    ``count``, a column of that name (replaced, if there is one) gives the number of entities; with
    ``n_chars``, a column of that name that holds the length of the text follows a changed text.
    Rows are matched to their surrogates by a digest of the list of their entities, so ids are not
    needed, copies are looked up once, and a popular entity is joined through the distinct lists.
    """
    mark = "_" + "_".join(docs.columns)
    text, listed = F.col(f"`{text_col}`"), F.col(f"`{mark}`")
    has = F.coalesce(text.rlike(ANY), F.lit(False))
    plain = docs.filter(~has)
    hit = docs.filter(has).withColumn(mark, F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    key_of = F.sha2(F.array_join(listed, "\x1f"), 256)
    lists = stored(hit.select(key_of.alias("key"), listed.alias("list")).groupBy("key").agg(F.first("list").alias("list")))
    places = lists.select("key", F.posexplode("list").alias("at", "surface"))
    table = stored(surrogates(places.select("surface").distinct(), key))
    made = (places.join(table, "surface").groupBy("key")
            .agg(F.array_sort(F.collect_list(F.struct("at", "surrogate"))).alias("made"))
            .select(F.col("key").alias(mark + "key"), F.col("made.surrogate").alias(mark + "made")))
    changed = (hit.withColumn(mark + "key", key_of).join(made, mark + "key")
               .withColumn(text_col, replaced(text, F.col(f"`{mark}made`"))))
    if n_chars:
        changed = changed.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType))
    columns = [F.col(f"`{c}`") for c in docs.columns if c != count]
    number = lambda n: [n.cast("long").alias(count)] if count else []
    return plain.select(*columns, *number(F.lit(0))).unionByName(changed.select(*columns, *number(F.size(listed))))
