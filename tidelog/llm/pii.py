"""Surrogates for personal data, with DataFrame functions alone.

One pattern finds e-mail and IPv4 addresses, telephone, card, account and social security numbers,
access keys, secrets after a name, and persons after a title or a given name. In a document that names persons,
their given names and surnames are found where they stand alone, too. Each entity becomes a
keyed, type-consistent surrogate: digits stay digits, letters keep case, separators stay, card
numbers (sixteen digits with a right check digit) keep their issuer digit and stay valid, telephone numbers keep their country code, whatever
the spelling; given names keep gender and script (a name of unknown gender gets one that any gender bears),
surnames keep script, and each part of a name has its own surrogate, so `Mr Reed` and `Anna
Reed` still agree. A surrogate depends on the key, the kind and the value only: the same entity has
the same one in every document. The key is a secret that the caller brings. A given name's kind is its gender: a listed name's own, else what a
title in the same document says of that name, else unknown.

Distinctness is checked over all documents: the distinct entities and their surrogates are compared,
and of values that share one, or whose surrogate is itself a detected value, all but the first move to their
next attempt until none is left. The space of surrogates grows with the attempt (more names, syllables, characters, other
address ranges), so it does not run out. Only documents that hold a moved value take part in a join.

Defined results: null texts stay null with 0 entities; empty texts stay empty; texts without
entities are returned as they are; repeated rows are treated each, alike; an empty table gives no rows;
other columns pass unread, n_chars follows the text. Values that still share a surrogate after MOST_ATTEMPTS rounds are a
RuntimeError; that takes more distinct IPv4 addresses than about half of all that exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, cut_narrow, packed, spread_left_join, unpacked

#: Documents with entities of a second attempt are broadcast up to so many rows.
MOST_BROADCAST = 2_000
MOST_ATTEMPTS = 200
#: From so many attempts on, and again at each multiple, a value gains one character.
GROWS = 4

#: Given names by script and gender; they are both detected and used.
GIVEN = {
    ("latin", "f"): "Anna Mary Laura Julia Emma Sophie Clara Helen Alice Maria Sarah Nina Eva Ruth Lucy Paula Irene Marta Elena Diana Carmen Claire Linda Karin".split(),
    ("latin", "m"): "John Peter Paul James Thomas David Robert Martin Karl Simon Oscar Victor Hugo Daniel Stefan Marco Luis Pedro Jean Pierre Henri Carlos Michael William".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Ирина Наталья Татьяна Светлана Вера Нина Юлия Дарья".split(),
    ("cyrillic", "m"): "Иван Пётр Алексей Сергей Дмитрий Николай Михаил Андрей Павел Олег Борис Виктор".split(),
    ("greek", "f"): "Μαρία Ελένη Άννα Σοφία Κατερίνα Ειρήνη Δήμητρα Ιωάννα".split(),
    ("greek", "m"): "Γιώργος Νίκος Γιάννης Δημήτρης Κώστας Παύλος Πέτρος Ανδρέας".split(),
}
#: Given names that any gender bears.
NEUTRAL = {
    "latin": "Alex Robin Kim Sam Chris Jamie Taylor Morgan Casey Jordan Riley Sasha Charlie Robbie Noel Dominique".split(),
    "cyrillic": "Саша Женя Валя Шура Слава Ника Паша Тоша".split(),
    "greek": "Άλεξ Σάσα Κρις Σαμ Νικόλ Ρόμπιν".split(),
}
#: Syllables of surnames by script.
SYLLABLES = {
    "latin": "bar den fal gor hal ker lan mor nes ol per quin ros sta tor ven".split(),
    "cyrillic": "бар ден фал гор лан мор нес кор пер рос ста тор вен зар лем дов".split(),
    "greek": "βαρ δεν φαλ γορ λαν μορ νες κορ περ ροσ στα τορ βεν ζαρ λεμ παπ".split(),
}
TITLES_F, TITLES_M = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Κυρία"), ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Κύριος")
TITLES_N = ("Dr", "Prof")

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}(?:\p{Ll}|['’](?!s(?!\p{L}))\p{Ll})+(?:-\p{Lu}\p{Ll}+)?"
_ALL_GIVEN = "|".join(n for names in GIVEN.values() for n in names)
_ALL_TITLES = "|".join((*TITLES_F, *TITLES_M, *TITLES_N))
#: (kind, first characters, pattern), tried in this order at each place.
PATTERNS = (
    ("secret", "PpSsTtAa", r"(?<![A-Za-z])(?i:password|passwd|pwd|secret|token|api_?key)\s{0,2}[=:]\s{0,2}[\"']?(?=[A-Za-z0-9_+/=~.-]{5,}?[A-Za-z0-9_+/=~-])(?:\.*+[A-Za-z0-9_+/=~-]++)++"),
    ("key", "A", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"),
    ("iban", "A-Z", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("card", "2-6", r"(?<![\d.-])[2-6]\d{3}[ -]?(?:\d{4}[ -]?){2}\d{4}(?![\d-])"),
    ("ssn", r"\d", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("ip", r"\d", rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"),
    ("phone", r"\d(+", r"(?<![\d.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]?\d{4}(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)"),
    ("email", "A-Za-z0-9._%+-", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}"),
    ("person", r"\p{Lu}", rf"(?<!\p{{L}})(?:(?:{_ALL_TITLES})\.?\s{_NAME}(?:\s{_NAME})?|(?:{_ALL_GIVEN})\s{_NAME})"),
)
PATTERN = "|".join(f"(?=[{first}])(?:{p})" for _, first, p in PATTERNS)
#: A text without any of this has no entity; it is one cheap pass.
GATE = rf"[0-9@=:]|(?=\p{{Lu}})(?<!\p{{L}})(?:{_ALL_TITLES}|{_ALL_GIVEN})(?!\p{{L}})"
#: How a found entity shows its kind; anchored, on the entity alone.
_KINDS = (
    ("email", r"^[^\s@]+@"), ("key", r"^A[KS]IA[0-9A-Z]{16}$"), ("secret", r"^(?i:password|passwd|pwd|secret|token|api_?key)\s*[=:]"),
    ("iban", r"^[A-Z]{2}\d"), ("ssn", r"^\d{3}-\d{2}-\d{4}$"), ("card", r"^(?:\d{4}[ -]?){3}\d{4}$"), ("ip", r"^\d+\.\d+\.\d+\.\d+$"), ("phone", r"^[+(\d]"),
)
#: A capitalised word that may be a name standing alone.
_BARE = rf"(?<!\p{{L}}){_NAME}(?!\p{{L}})"
#: Country calling codes by length, of a telephone number in its normal form.
_CALLING = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_SECRET_HEAD = r"^(\w+\s*[=:]\s*[\"']?)(.*)$"
_TITLE_HEAD = rf"^((?:{_ALL_TITLES})\.?\s)(.*)$"


def found(text: Column) -> Column:
    """What the pattern matches; `real` tells which of it is an entity."""
    return F.when(text.rlike(GATE), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def kind_of(entity: Column) -> Column:
    out = F.when(entity.rlike(_KINDS[0][1]), _KINDS[0][0])
    for kind, pattern in _KINDS[1:]:
        out = out.when(entity.rlike(pattern), kind)
    return out.otherwise("person")


def real(entity: Column) -> Column:
    """A number of a card's length is one only if its check digit is right."""
    return F.when(kind_of(entity) == "card", _luhn_sum(_digits(entity)) == 0).otherwise(True)


def normal(kind: Column, value: Column) -> Column:
    """What makes two spellings one entity: digits of numbers, case of addresses."""
    return (
        F.when(kind.isin("card", "ssn"), F.regexp_replace(value, r"[^\d]", "")).when(kind == "phone", F.regexp_replace(value, r"(?!^\+)[^\d]", ""))
        .when(kind == "iban", F.regexp_replace(value, " ", "")).when(kind == "email", F.lower(value)).otherwise(value)
    )


def parts_of(entity: Column) -> Column:
    """array<struct<kind, value>>: what is replaced in an entity; names have a part for each word."""
    kind = kind_of(entity)
    title = F.regexp_extract(entity, _TITLE_HEAD, 1)
    bare = F.when(title == "", entity).otherwise(F.regexp_extract(entity, _TITLE_HEAD, 2))
    words = F.split(bare, r"\s")
    gender = (
        F.when(title.rlike(f"^(?:{'|'.join(TITLES_F)})\\b"), "f").when(title.rlike(f"^(?:{'|'.join(TITLES_M)})\\b"), "m").otherwise("")
    )
    bearers = lambda gender: [n for (_, g), names in GIVEN.items() if g == gender for n in names]
    gender = F.when(words[0].isin(bearers("f")), "f").when(words[0].isin(bearers("m")), "m").otherwise(gender)
    given = F.struct(F.when(gender == "m", "given_m").when(gender == "f", "given_f").otherwise("given_n").alias("kind"), words[0].alias("value"))
    surname = lambda w: F.struct(F.lit("surname").alias("kind"), w.alias("value"))
    person = F.when(F.size(words) > 1, F.array(given, surname(words[1]))).otherwise(F.array(surname(words[0])))
    value = F.when(kind == "secret", F.regexp_extract(entity, _SECRET_HEAD, 2)).otherwise(entity)
    return F.when(kind == "person", person).otherwise(F.array(F.struct(kind.alias("kind"), value.alias("value"))))


def _digest(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """Keyed hash as 128 hexadecimal digits: an inner and an outer pass over the key."""
    inner = F.sha2(F.concat(F.lit(key + "|in|"), kind, F.lit("|"), normal(kind, value), F.lit("|"), attempt.cast("string")).cast("binary"), 512)
    return F.sha2(F.concat(F.lit(key + "|out|"), inner).cast("binary"), 512)


def _number(digest: Column, at: Column | int) -> Column:
    """A value below 65536 from the digest, by place."""
    place = at if isinstance(at, Column) else F.lit(at)
    return F.conv(F.substr(digest, (place * 3) % 124 + 1, F.lit(4)), 16, 10).cast("int")


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _scramble(value: Column, digest: Column, hexadecimal: Column, first: Column) -> Column:
    """Each digit by a digit, each letter by one of its case; all else stays, and so do the `first` ones. Characters go by their place among those."""
    gaps = F.split(value, r"[\p{L}\d]", -1)

    def one(c, i):
        pick = lambda n: (
            F.when(hexadecimal, F.substr(F.lit("0123456789abcdef"), n % 16 + 1, F.lit(1)))
            .otherwise(F.char(F.when(c.rlike(r"^\d$"), n % 10 + 48).when(c.rlike(r"^\p{Lu}$"), n % 26 + 65).otherwise(n % 26 + 97)))
        )
        return F.when(i < first, c).otherwise(_let(_number(digest, i), pick))

    mixed = F.transform(F.regexp_extract_all(value, F.lit(r"[\p{L}\d]"), F.lit(0)), one)
    rest = lambda g: F.slice(g, 2, F.greatest(F.size(g) - 1, F.lit(1)))
    return _let(gaps, lambda g: F.concat(g[0], F.array_join(F.zip_with(mixed, rest(g), lambda m, x: F.concat(m, x)), "")))


def _luhn_sum(digits: Column) -> Column:
    """The card check's sum, last digit included, as a remainder of 10."""
    n = F.length(digits)
    each = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.substr(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^\d]", "")


def _checked(mixed: Column) -> Column:
    """A card number with a right check digit."""
    last = F.substr(mixed, F.length(mixed), F.lit(1)).cast("int")
    right = (last - _luhn_sum(_digits(mixed)) + 10) % 10
    return F.concat(F.substr(mixed, F.lit(1), F.length(mixed) - 1), right.cast("string"))


def _strings(names: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in names])


def _by_script(value: Column, of) -> Column:
    return F.when(value.rlike(r"^\p{IsCyrillic}"), of("cyrillic")).when(value.rlike(r"^\p{IsGreek}"), of("greek")).otherwise(of("latin"))


def _given(kind: Column, value: Column, digest: Column, attempt: Column) -> Column:
    of = lambda names: _by_script(value, lambda s: _strings(names(s)))
    names = F.when(kind == "given_m", of(lambda s: GIVEN[s, "m"])).when(kind == "given_f", of(lambda s: GIVEN[s, "f"])).otherwise(of(NEUTRAL.get))
    # names joined by hyphens; every second attempt has one more, so that there are always enough
    count = F.lit(1) + F.floor((attempt + 1) / 2).cast("int")
    return _let(names, lambda a: F.array_join(F.transform(F.sequence(F.lit(1), count), lambda k: F.element_at(a, _number(digest, k * 4 - 3) % F.size(a) + 1)), "-"))


def _surname(value: Column, digest: Column, attempt: Column) -> Column:
    count = F.lit(3) + F.floor((attempt + 1) / 2).cast("int")
    return _let(
        _by_script(value, lambda s: _strings(SYLLABLES[s])),
        lambda a: F.initcap(F.array_join(F.transform(F.sequence(F.lit(1), count), lambda k: F.element_at(a, _number(digest, k * 4) % F.size(a) + 1)), "")),
    )


def _ip(digest: Column, attempt: Column) -> Column:
    """An address: first of the private 10.0.0.0/8, then of the reserved 240.0.0.0/4, then any."""
    octet = lambda k, n: _number(digest, 7 * k) % n + 1
    first = F.when(attempt == 0, 10).when(attempt == 1, 239 + octet(4, 15)).otherwise(octet(4, 223))
    return F.concat_ws(".", first.cast("string"), *[octet(k, 254).cast("string") for k in (1, 2, 3)])


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """What stands for a value of this kind; issuer digit, country code, key prefix and country are kept."""
    plain = normal(kind, value)
    first = (
        F.when(kind == "card", 1).when(kind == "key", 4).when(kind == "iban", 2)
        .when((kind == "phone") & plain.startswith("+"), F.length(F.regexp_extract(plain, _CALLING, 0)) - 1).otherwise(0)
    )

    def with_digest(d):
        body = F.when(kind == "email", F.substring_index(value, "@", 1)).otherwise(value)
        hexadecimal = (kind == "secret") & value.rlike(r"^[0-9a-f]+$")
        host = F.concat(F.lit("@mail"), (_number(d, 20) % 1000).cast("string"), F.lit(".example."), F.element_at(_strings(["com", "net", "org"]), _number(d, 24) % 3 + 1))
        more = F.floor(attempt / GROWS).cast("int")
        digit = lambda k: F.char(_number(d, 30 + k) % 10 + 48)
        extra = F.when(more > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(more, F.lit(1))), digit), "")).otherwise("")
        changed = _let(
            F.concat(_scramble(body, d, hexadecimal, first), extra),
            lambda m: F.when(kind == "card", _checked(m)).when(kind == "email", F.concat(m, host)).otherwise(m),
        )
        return F.when(kind == "ip", _ip(d, attempt)).when(kind.startswith("given"), _given(kind, value, d, attempt)).when(kind == "surname", _surname(value, d, attempt)).otherwise(changed)

    return _let(_digest(kind, value, attempt, key), with_digest)


def entities(docs: DataFrame) -> DataFrame:
    """Distinct (kind, value) over all texts, value in its normal form, with one spelling of it."""
    each = docs.select(F.explode(found(F.col("text"))).alias("e")).groupBy("e").count().where(real(F.col("e"))).select(F.explode(parts_of(F.col("e"))).alias("p"))
    return each.groupBy(F.col("p.kind").alias("kind"), normal(F.col("p.kind"), F.col("p.value")).alias("value")).agg(F.min("p.value").alias("spelling"))


def attempts(docs: DataFrame, key: str) -> DataFrame:
    """(kind, value, attempt) for the values whose first surrogate is taken; attempt is 1 or more."""
    known = cut(entities(docs))
    n = known.count()
    real = known.select(F.col("kind").alias("_kind"), F.col("value").alias("_real"))
    state = known.withColumns({"attempt": F.lit(0), "moved": F.lit(True), "s": F.lit(None).cast("string")})
    for _ in range(MOST_ATTEMPTS):
        # only values that moved get a new surrogate
        s = F.when(F.col("moved"), normal(F.col("kind"), surrogate(F.col("kind"), F.col("spelling"), F.col("attempt"), key))).otherwise(F.col("s"))
        state = state.select("kind", "value", "spelling", "attempt", s.alias("s"))
        shared = state.groupBy("kind", "s").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "value")).alias("first")).where("n > 1").select(F.col("kind").alias("k2"), F.col("s").alias("s2"), "first")
        t = state.join(shared, (F.col("kind") == F.col("k2")) & (F.col("s") == F.col("s2")), "left")
        t = t.join(real, (F.col("kind") == F.col("_kind")) & (F.col("s") == F.col("_real")), "left")
        # given names come from short lists, so a surrogate may be a name that others bear
        taken = (F.col("_real").isNotNull() & ~F.col("kind").startswith("given")) | (F.col("_real") == F.col("value"))
        moves = F.coalesce(F.struct("attempt", "value") != F.col("first"), F.lit(False)) | F.coalesce(taken, F.lit(False))
        state = cut_narrow(t.select("kind", "value", "spelling", "s", (F.col("attempt") + moves.cast("int")).alias("attempt"), moves.alias("moved")), n)
        if not state.where("moved").head(1):
            return state.where("attempt > 0").select("kind", "value", "attempt")
    raise RuntimeError(f"surrogates stay shared after {MOST_ATTEMPTS} attempts")


def _part(p: Column, names: Column | None, later: Column | None, key: str) -> Column:
    """What stands for a part of an entity; `names` are the parts of the document's persons, `later` maps kind:value to its attempt."""
    kind = p["kind"]
    if names is not None:
        told = F.filter(names, lambda x: (x["value"] == p["value"]) & x["kind"].isin("given_m", "given_f"))
        kind = F.when((kind == "given_n") & (F.size(told) > 0), F.array_min(told)["kind"]).otherwise(kind)
    one = lambda k: surrogate(
        k, p["value"], F.lit(0) if later is None else F.coalesce(F.element_at(later, F.concat(k, F.lit(":"), normal(k, p["value"]))), F.lit(0)), key
    )
    return _let(kind, one)


def _replaced(entity: Column, names: Column, later: Column | None, key: str) -> Column:
    """The entity with its parts replaced."""
    kind = kind_of(entity)
    done = F.array_join(F.transform(parts_of(entity), lambda p: _part(p, names, later, key)), " ")
    head = F.when(kind == "secret", F.regexp_extract(entity, _SECRET_HEAD, 1)).when(kind == "person", F.regexp_extract(entity, _TITLE_HEAD, 1)).otherwise("")
    return F.when(real(entity), F.concat(head, done)).otherwise(entity)


def _named(gap: Column, names: Column) -> Column:
    """Words of a stretch between entities that are names of the document's persons."""
    return F.filter(F.regexp_extract_all(gap, F.lit(_BARE), F.lit(0)), lambda w: F.exists(names, lambda x: x["value"] == w))


def _between(gap: Column, names: Column, later: Column | None, key: str) -> Column:
    """A stretch between entities, names of the document's persons replaced."""
    words, rest = F.regexp_extract_all(gap, F.lit(_BARE), F.lit(0)), F.split(gap, _BARE, -1)

    def one(w):
        same = F.filter(names, lambda x: x["value"] == w)
        return F.when(F.size(same) > 0, _part(F.array_min(same), names, later, key)).otherwise(w)

    tail = lambda r: F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(1)))
    whole = _let(rest, lambda r: F.concat(r[0], F.array_join(F.zip_with(F.transform(words, one), tail(r), lambda w, x: F.concat(w, x)), "")))
    return F.when(F.size(_named(gap, names)) > 0, whole).otherwise(gap)


def _beside(rows: DataFrame, per: DataFrame, key: Column) -> DataFrame:
    """Rows with `_later` of their text (`per`: _h, _later, _times), NULL where it has none. Few texts are broadcast."""
    few, total = per.agg(F.count("*") <= MOST_BROADCAST, F.sum("_times")).first()
    if few:
        return rows.join(F.broadcast(per.drop("_times")), key == F.col("_h"), "left").drop("_h")
    return spread_left_join(rows, per, key, "_h", "_times", total)


def _rows(docs: DataFrame, key: str) -> DataFrame:
    """`_row` with the input's columns, the new `_text`, and `_n`, the number of entities."""
    fixed = attempts(docs, key)
    rows = docs.select(packed(docs))
    text = F.col("_row")["text"]
    # without a real entity there is nothing to replace
    none = F.array().cast("array<string>")
    rows = rows.withColumn("_found", F.coalesce(found(text), none)).withColumn("_found", F.when(F.exists("_found", real), F.col("_found")).otherwise(none))
    later = None
    if fixed.head(1):
        ids = docs.select(F.xxhash64(F.col("text")).alias("_h"), F.explode(found(F.col("text"))).alias("e")).where(real(F.col("e"))).select("_h", F.explode(parts_of(F.col("e"))).alias("p"))
        ids = ids.select("_h", F.col("p.kind").alias("k"), normal(F.col("p.kind"), F.col("p.value")).alias("v"))
        per = ids.join(fixed, (F.col("k") == F.col("kind")) & (F.col("v") == F.col("value"))).select("_h", F.struct(F.concat("k", F.lit(":"), "v"), "attempt").alias("kv"))
        per = cut(per.groupBy("_h").agg(F.map_from_entries(F.collect_set("kv")).alias("_later"), F.count("*").alias("_times")))
        rows = _beside(rows, per, F.when(F.size("_found") > 0, F.xxhash64(text)))
        later = F.coalesce(F.col("_later"), F.create_map().cast("map<string,int>"))
    no_names = F.array().cast("array<struct<kind:string,value:string>>")
    persons = F.filter("_found", lambda e: kind_of(e) == "person")
    names = F.when(F.size("_found") > 0, F.array_distinct(F.flatten(F.transform(persons, parts_of)))).otherwise(no_names)
    gaps = F.when(F.size("_found") > 0, F.split(text, PATTERN, -1))
    rows = rows.withColumns({"_names": names, "_gaps": gaps})
    between = lambda g: F.when(F.size("_names") > 0, _between(g, F.col("_names"), later, key)).otherwise(g)
    gaps = F.col("_gaps")
    each = F.zip_with(F.col("_found"), F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(1))), lambda e, g: F.concat(_replaced(e, F.col("_names"), later, key), between(g)))
    joined = F.concat(between(gaps[0]), F.array_join(each, ""))
    alone = F.when(F.size("_names") > 0, F.aggregate(gaps, F.lit(0), lambda n, g: n + F.size(_named(g, F.col("_names"))))).otherwise(0)
    return rows.withColumns({"_text": F.when(F.size("_found") > 0, joined).otherwise(text), "_n": (F.size(F.filter("_found", real)) + alone).cast("long")})


def _replaced_columns(docs: DataFrame) -> list[Column]:
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("_found") > 0, F.length("_text").cast("long")).otherwise(F.col("_row")["n_chars"])
    return unpacked(docs, **changed)


def surrogates(docs: DataFrame, key: str) -> DataFrame:
    """The input's rows and columns, text replaced, and n_entities long (in place of a column of that name)."""
    kept = docs.drop("n_entities")
    return _rows(kept, key).select(*_replaced_columns(kept), F.col("_n").alias("n_entities"))


def replaced_documents(docs: DataFrame, key: str) -> DataFrame:
    return _rows(docs, key).select(*_replaced_columns(docs))


def session_key(spark: SparkSession) -> str:
    """The session's spark.tidelog.surrogateKey. Without it, a key for tests, which keeps nothing secret."""
    return spark.conf.get("spark.tidelog.surrogateKey", None) or "for tests only"
