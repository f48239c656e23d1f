"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Only DataFrame and SQL functions. One alternation of patterns finds the entities of a text; the text between them stays.
Each distinct entity gets its surrogate once, from a keyed hash of its type and normal form, so that it reads the same
wherever it occurs; e-mail case, card and phone punctuation and titles of a name are kept. What has digits or letters to
vary is varied place by place within its alphabet (digits stay digits, hex stays hex, upper case stays upper case).

Coreference: the parts of a name are entities of their own, a surname and a given name of one gender, so that "Mr. John
Smith", "Mr. Smith", "John Smith" and "Smith" keep one surname and one given name, in a text and across texts. Names are
found after titles; a word that a title has shown to be a name in a text is replaced wherever it stands in that text.
After titles that leave the gender open it is taken from the text's other mentions of the given name, if they agree.

Distinctness is checked: a surrogate that two entities share, or that is itself an entity of the corpus, is drawn again
with the next counter, until none is left. Names get longer with every attempt, forms of fixed width from the ninth on, so
drawing ends for every corpus. Entities meet in joins and grouped counts by surrogate, never on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.common import cut, packed_rows, unpacked_rows

#: Titles before a name.
TITLE = r"(?:Mrs?|Ms|Miss|Mme|Mlle|Monsieur|Madame|Herrn?|Frau|Señora?|Señorita|Sra?|Don|Doña|Dr|Prof|г-н|г-жа)"
#: A word of a name; up to four are joined by hyphens.
WORD = r"\p{Lu}(?:['’]\p{Lu})?\p{L}+"
#: Patterns of the entity types, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?:[\p{L}\p{N}][\p{L}\p{N}\-]*\.)+\p{L}{2,}",
    "secret": r"(?<![A-Za-z])(?i:password|passwd|pwd|token|secret|api[_\-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_\-]{8,}",
    "key": r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "card": r"(?<![\d.\-])(?:[2-6]\d{3}(?:[ \-]?\d{4}){3}(?:\d{3})?|3[47]\d{2}[ \-]?\d{6}[ \-]?\d{5})(?![\d\-])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\d)",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?)\d{3,4}[ .\-]\d{3,4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,4}(?!\d)|(?<![\d+.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])",
    "name": rf"(?<!\p{{L}}){TITLE}\.? {WORD}(?:-{WORD}){{0,3}}(?: (?!{TITLE}(?!\p{{L}})){WORD}(?:-{WORD}){{0,3}})?",
}
#: Titles after which a name is of any gender, and female; after the others it is male.
OPEN = ("Dr", "Prof")
FEMALE = ("Mrs", "Ms", "Miss", "Mme", "Mlle", "Madame", "Frau", "Señora", "Señorita", "Sra", "Doña", "г-жа")
#: Names of surrogates by script and gender.
GIVEN = {
    ("latin", "f"): ("Alma", "Bella", "Clara", "Diana", "Elena", "Flora", "Greta", "Hanna", "Irene", "Julia", "Karla", "Linda", "Maria", "Nora", "Olga", "Paula"),
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Gustav", "Hugo", "Ivan", "Jonas", "Konrad", "Leo", "Martin", "Noel", "Oscar", "Paul"),
    ("latin", "o"): ("Alex", "Bobbie", "Charlie", "Dominique", "Eden", "Frankie", "Gabi", "Jules", "Kim", "Lou", "Maxi", "Nicky", "Robin", "Sam", "Toni", "Uli"),
    ("cyrillic", "o"): ("Валя", "Вася", "Витя", "Гоша", "Женя", "Миша", "Никола", "Паша", "Саша", "Слава", "Тоша", "Шура"),
    ("cyrillic", "f"): ("Алина", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Инна", "Клара", "Лидия", "Мария", "Нина", "Ольга", "Раиса", "Софья", "Юлия"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Юрий"),
}
#: Syllables of surrogate surnames by script.
SYLLABLES = {
    "latin": ("bar", "den", "fal", "gor", "han", "kel", "lin", "mar", "nor", "pel", "ros", "san", "tor", "vel", "win", "zan"),
    "cyrillic": ("бар", "ден", "фал", "гор", "хан", "кел", "лин", "мар", "нор", "пел", "рос", "сан", "тор", "вел", "вин", "зан"),
}
#: A text without any of these has no entity: what is cheap to look for goes before the patterns.
HINTS = ("Dr ", "Dr. ", "Prof", "Mr", "Ms", "Miss", "Mme", "Mlle", "Monsieur", "Madame", "Herr", "Frau", "Señor", "Sr", "Don ", "Don. ", "Doña", "г-н", "г-жа", "AKIA", "ghp_", "sk-")
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: As ANY, and after it any capitalised word, for texts that hold names. A word ends where an entity begins.
ANY_OR_WORD = rf"{ANY}|(?<!\p{{L}}){WORD}(?:-(?!{ANY}){WORD}){{0,3}}(?![\p{{L}}\p{{N}}@])"
#: Alphabets of letters outside A-Z that vary within their script.
ALPHABETS = {"IsCyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "IsGreek": "αβγδεζηθικλμνξοπρτυφχψω"}
#: Attempts of a form's own width; further ones add two places each.
SAME_WIDTH = 8


def _digest(key: str, kind: Column, base: Column, attempt: Column) -> Column:
    """256 keyed bits as 64 hex digits: the key is hashed in on both sides, so none of it can be left off."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), F.sha2(F.concat_ws("\x1f", F.lit(key), kind, base, attempt.cast("string")), 256)), 256)


def _nibble(digest: Column, i: Column) -> Column:
    """Byte i of a digest as a number; beyond 31 it goes round."""
    return F.conv(F.substring(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _varied(text: Column, digest: Column, fixed: Column, hex_only: Column) -> Column:
    """`text` with digits and letters from position `fixed` on replaced within their alphabet, by one byte each."""
    def place(c: Column, i: Column) -> Column:
        byte = _nibble(F.when(i < 32, digest).otherwise(F.sha2(F.concat(digest, F.floor(i / 32).cast("string")), 256)), i)
        return F.struct(c.alias("c"), i.alias("i"), byte.alias("v"))

    def change(at: Column) -> Column:
        c, i, v = at["c"], at["i"], at["v"]
        digit = F.chr(F.lit(48) + v % 10)
        lower = F.chr(F.lit(97) + v % F.when(hex_only, F.lit(6)).otherwise(F.lit(26)))
        upper = F.chr(F.lit(65) + v % F.when(hex_only, F.lit(6)).otherwise(F.lit(26)))
        out = F.when(i < fixed, c).when(c.rlike("^[0-9]$"), digit).when(c.rlike("^[a-z]$"), lower).when(c.rlike("^[A-Z]$"), upper)
        for script, letters in ALPHABETS.items():
            letter = F.substring(F.lit(letters), v % len(letters) + 1, F.lit(1))
            out = out.when(c.rlike(rf"^\p{{{script}}}$"), F.when(c.rlike(r"^\p{Lu}$"), F.upper(letter)).otherwise(letter))
        return out.when(c.rlike(r"^\p{Lu}$"), upper).when(c.rlike(r"^\p{L}$"), lower).otherwise(c)

    # The byte of a place stands in the expression once, not in every branch: plans stay small.
    return F.array_join(F.transform(F.transform(F.split(text, ""), place), change), "")


def _kind(entity: Column) -> Column:
    """Type of a match: the first pattern that matches it whole."""
    return reduce(lambda out, k: out.when(entity.rlike(f"^(?:{PATTERNS[k]})$"), F.lit(k)), list(PATTERNS)[1:], F.when(entity.rlike(f"^(?:{PATTERNS['email']})$"), F.lit("email")))


def _base(kind: Column, entity: Column) -> Column:
    """Normal form: what is the same entity has the same one, however it is written."""
    digits = F.regexp_replace(entity, r"\D", "")
    tail = F.regexp_replace(entity, r"^\P{L}*(?i:password|passwd|pwd|token|secret|api[_\-]?key)\s*[=:]\s*[\"']?", "")
    return F.when(kind == "email", F.lower(entity)).when(kind.isin("card", "phone", "ssn"), digits).when(kind == "secret", tail).when(kind == "iban", F.regexp_replace(entity, " ", "")).otherwise(entity)


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every other one from the right twice, less 9 above 9: a multiple of 10 for card numbers."""
    terms = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, F.lit(9)).otherwise(F.lit(0))))
    return F.aggregate(terms, F.lit(0), lambda a, b: a + b)


def _pick(values: tuple[str, ...], v: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in values]), (v % len(values) + 1).cast("int"))


def _core(kind: Column, base: Column, digest: Column, attempt: int) -> Column:
    """Surrogate of a normal form.

    Surnames get a syllable and given names a name more with every attempt. Other forms get two places more with every
    attempt beyond SAME_WIDTH, and addresses go on to the private addresses of the longer kind: none runs out.
    """
    grow = 2 * max(0, attempt + 1 - SAME_WIDTH)
    country = F.greatest(F.length(base) - 10, F.lit(0))  # places of a phone number before the last ten
    local = F.substring_index(base, "@", 1)
    base = F.when(kind.isin("card", "phone", "ssn", "key", "secret", "iban"), F.concat(base, F.lit("0" * grow))).otherwise(base)

    def byte(i: int) -> Column:
        return _nibble(digest, F.lit(i))

    none = F.lit(False)
    email = F.concat(_varied(local, digest, F.lit(0), none), F.lit("@"), F.substring(F.sha2(digest, 256), 1, 10), F.lit(".example.com"))
    body = _varied(base, digest, F.lit(1), none)  # first digit of a card: its scheme
    partial = F.substring(body, F.lit(1), F.length(body) - 1)
    card = F.concat(partial, ((F.lit(10) - _luhn(F.concat(partial, F.lit("0"))) % 10) % 10).cast("string"))
    ip = F.concat_ws(".", F.lit("10"), *[byte(i).cast("string") for i in range(3)])  # a private network
    if grow:
        ip = F.concat_ws(":", F.concat(F.lit("fd"), F.substring(digest, 1, 2)), *[F.substring(digest, 4 * i + 1, 4) for i in range(1, 8)])
    phone = _varied(base, digest, country, none)
    is_hex = base.rlike("^[0-9a-f]+$") | base.rlike("^[0-9A-F]+$")
    prefix = F.length(F.regexp_extract(base, r"^(AKIA|ghp_|sk-)", 1))
    key = _varied(base, digest, prefix, none)
    secret = _varied(base, digest, F.lit(0), is_hex)
    iban = _varied(base, digest, F.lit(2), none)
    cyrillic = base.rlike(r"\p{IsCyrillic}")

    def surname(script: str) -> Column:
        return F.initcap(F.concat(*[_pick(SYLLABLES[script], byte(i)) for i in range(1, 4 + attempt)]))

    def given(gender: str) -> Column:
        latin, other = (F.concat_ws("-", *[_pick(GIVEN[script, gender], byte(i)) for i in range(1 + attempt)]) for script in ("latin", "cyrillic"))
        return F.when(cyrillic, other).otherwise(latin)

    ending = F.when(base.rlike("[ая]$"), F.lit("а")).otherwise(F.lit(""))  # a woman's form of a surname
    name = F.when(cyrillic, F.concat(surname("cyrillic"), ending)).otherwise(surname("latin"))
    chosen = {"email": email, "card": card, "ip": ip, "phone": phone, "ssn": _varied(base, digest, F.lit(0), none), "key": key, "secret": secret, "iban": iban, "name": name, **{f"given_{g}": given(g) for g in "fmo"}}
    return reduce(lambda out, k: out.when(kind == k, chosen[k]), list(chosen)[1:], F.when(kind == "email", email))


def _written(kind: Column, entity: Column, base: Column, core: Column) -> Column:
    """The surrogate in the format in which the entity is written."""
    chars, digits = F.split(entity, ""), F.split(core, "")
    place = F.aggregate(
        chars,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("n")),
        lambda s, c: F.struct(F.concat(s["out"], F.when(c.rlike("^[0-9A-Za-z]$"), F.element_at(digits, s["n"] + 1)).otherwise(c)).alias("out"), (s["n"] + F.when(c.rlike("^[0-9A-Za-z]$"), 1).otherwise(0)).alias("n")),
        lambda s: F.concat(s["out"], F.array_join(F.slice(digits, s["n"] + 1, F.greatest(F.size(digits) - s["n"], F.lit(0))), "")),
    )
    upper = (entity == F.upper(entity)) & (entity != F.lower(entity))
    head = F.substring(entity, F.lit(1), F.length(entity) - F.length(base))
    return F.when(kind == "email", F.when(upper, F.upper(core)).otherwise(core)).when(kind.isin("card", "phone", "ssn", "iban"), place).when(kind == "secret", F.concat(head, core)).otherwise(core)


def occurrences(docs: DataFrame) -> DataFrame:
    """(a, b, entity, kind, base): each entity as written, once per distinct text (a and b are the text's key).

    A name gives a row for its surname and one for its given name. Digits alone are a card only if their check digit fits.
    """
    likely = reduce(lambda x, y: x | y, [F.col("text").contains(t) for t in HINTS], F.col("text").rlike("[@0-9=:]"))
    found = docs.where(likely).select(F.xxhash64("text").alias("a"), F.xxhash64(F.lit("second key"), "text").alias("b"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))).alias("entity"))
    found = found.distinct().withColumn("kind", _kind(F.col("entity"))).where("kind is not null")
    found = found.where((F.col("kind") != "card") | F.col("entity").rlike("[^0-9]") | (_luhn(F.regexp_replace("entity", r"\D", "")) % 10 == 0))
    title = F.regexp_replace(F.regexp_extract("entity", r"^\S+", 0), r"\.$", "")
    words = F.split("entity", " ")
    gender = F.when(title.isin(*FEMALE), F.lit("f")).when(~title.isin(*OPEN), F.lit("m"))
    is_name = F.col("kind") == "name"
    found = found.withColumns({"given": F.when(is_name & (F.size(words) > 2), words[1]), "surname": F.when(is_name, F.element_at(words, -1)), "gender": F.when(is_name, gender)})
    # A window sees the mentions of one given name in one text, or what else the text holds.
    same = Window.partitionBy("a", "b", "given")
    agreed = F.when(F.min("gender").over(same) == F.max("gender").over(same), F.min("gender").over(same))
    found = found.withColumn("gender", F.coalesce("gender", agreed, F.lit("o")))

    def part(kind: Column | str, base: Column | str) -> Column:
        return F.struct((F.col(kind) if isinstance(kind, str) else kind).alias("kind"), (F.col(base) if isinstance(base, str) else base).alias("base"))

    parts = F.when(is_name, F.array(part(F.lit("name"), "surname"), part(F.concat(F.lit("given_"), F.col("gender")), "given")))
    parts = parts.otherwise(F.array(part("kind", _base(F.col("kind"), F.col("entity")))))
    return found.select("a", "b", "entity", F.inline(parts)).where("base is not null")


def entities(found: DataFrame) -> DataFrame:
    """(kind, base) of the distinct entities among `occurrences`."""
    return found.select("kind", "base").distinct()


def replacements(found: DataFrame, table: DataFrame) -> DataFrame:
    """(a, b, entity, written): what stands in a text and what takes its place, names with and without title.

    A word that is a surname and a given name in one text reads as the surname where it stands alone, one of both
    genders as the female one.
    """
    is_name = (F.col("kind") == "name") | F.col("kind").startswith("given_")
    core, surname, none = F.col("core"), F.col("kind") == "name", F.lit(None).cast("string")
    whole = F.struct(F.col("entity").alias("key"), F.when(~is_name, _written(F.col("kind"), F.col("entity"), F.col("base"), core)).alias("plain"), F.when(surname, core).alias("last"), F.when(is_name & ~surname, core).alias("first"), none.alias("word_last"), none.alias("word_first"))
    word = F.struct(F.col("base").alias("key"), none.alias("plain"), none.alias("last"), none.alias("first"), F.when(surname, core).alias("word_last"), F.when(~surname, F.concat(F.substring("kind", -1, 1), core)).alias("word_first"))
    rows = found.join(table, ["kind", "base"]).select("a", "b", F.inline(F.when(is_name, F.array(whole, word)).otherwise(F.array(whole))))
    best = rows.groupBy("a", "b", "key").agg(*[F.min(c).alias(c) for c in ("plain", "last", "first", "word_last", "word_first")])
    titled = F.concat(F.regexp_extract("key", r"^\S+ ", 0), F.concat_ws(" ", "first", "last"))
    written = F.coalesce("plain", F.when(F.col("last").isNotNull(), titled), "word_last", F.substring("word_first", 2, 1 << 30))
    return best.select("a", "b", F.col("key").alias("entity"), written.alias("written"), F.col("last").isNotNull().alias("titled"))


def surrogate_table(known: DataFrame, key: str) -> DataFrame:
    """(kind, base, core): one surrogate per entity; no two are equal and none is an entity of the corpus."""

    def draw(rows: DataFrame, attempt: int) -> DataFrame:
        digest = _digest(key, F.col("kind"), F.col("base"), F.lit(attempt))
        return rows.withColumn("_digest", digest).withColumn("core", _core(F.col("kind"), F.col("base"), F.col("_digest"), attempt)).drop("_digest")

    def clashes(rows: DataFrame, settled: DataFrame | None) -> DataFrame:
        """Entities to draw again: all but the first of those that share a surrogate, or whose surrogate is taken."""
        first = rows.groupBy("kind", "core").agg(F.min("base").alias("first"))
        # Given names of all genders are one pool, and so are words of a name that may stand alone.
        real = known.select(pool.alias("pool"), F.col("base").alias("core"), F.lit(True).alias("real")).distinct()
        out = rows.withColumn("pool", pool).join(first, ["kind", "core"]).join(real, ["pool", "core"], "left")
        taken = (F.col("base") != F.col("first")) | F.col("real")
        if settled is not None:
            out = out.join(settled.select("kind", "core", F.lit(True).alias("gone")).distinct(), ["kind", "core"], "left")
            taken = taken | F.coalesce("gone", F.lit(False))
        return out.select("kind", "base", "core", F.coalesce(taken, F.lit(False)).alias("again"))

    pool = F.when((F.col("kind") == "name") | F.col("kind").startswith("given_"), F.lit("name")).otherwise(F.col("kind"))
    known = cut(known.select("kind", "base"))
    settled, rows, attempt = None, known, 0
    while True:
        drawn = cut(clashes(draw(rows, attempt), settled))
        good = drawn.where("not again").select("kind", "base", "core")
        settled = good if settled is None else settled.unionByName(good)
        rows, attempt = drawn.where("again").select("kind", "base"), attempt + 1
        if rows.isEmpty():
            return settled


def with_surrogates(docs: DataFrame, key: str = "stocktide") -> DataFrame:
    """`docs` with every entity of `text` replaced, and `n_chars`, where there is one, counted again.

    All rows and columns stay. Null and empty texts, and texts without entities, stay as they are. Repeated rows read
    alike; rows without doc_id are treated like the others. An empty table gives no rows.
    """
    # Entities go to the table and back by the key of their text; a frequent entity is split by AQE.
    found = cut(occurrences(docs))
    table = surrogate_table(entities(found), key)
    replaced = replacements(found, table).select(F.col("a").alias("_a"), F.col("b").alias("_b"), "entity", "written", "titled")
    of_text = cut(replaced.groupBy("_a", "_b").agg(F.map_from_entries(F.collect_list(F.struct("entity", "written"))).alias("_map"), F.max("titled").alias("_named")))
    # The row travels as one column, so that no name of it clashes.
    text = F.col("row")["text"]
    keyed = packed_rows(docs).withColumns({"_x": F.xxhash64(text), "_y": F.xxhash64(F.lit("second key"), text)})
    # The maps grow with the corpus, so they are never broadcast.
    joined = keyed.join(of_text.hint("merge"), (F.col("_x") == F.col("_a")) & (F.col("_y") == F.col("_b")), "left")

    def rewritten(pattern: str) -> Column:
        between, inside = F.split(text, pattern, -1), F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda e: F.coalesce(F.col("_map")[e], e))
        return F.array_join(F.zip_with(between, inside, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")

    joined = joined.withColumn("_new", F.when(F.col("_named"), rewritten(ANY_OR_WORD)).when(F.col("_map").isNotNull(), rewritten(ANY)))
    return unpacked_rows(joined, docs, F.col("_new"))
