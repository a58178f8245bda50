"""Surrogates for personal data, in DataFrame and SQL functions alone.

Entities (e-mail addresses, phone and card numbers, network addresses, account and social
security numbers, keys, titled names) are found by one pattern. Each is replaced by a value drawn from a
keyed hash of its normal form: so the same entity, however it is written, gets the same surrogate in
every document (coreference), of the same kind and shape: letters stay letters of their
script and case, digits digits, separators stay where they are, card numbers keep their check digit,
given names their gender.

A name is found after a title; each of its words is an entity, whatever the title. Where the same text
says such a word again without a title, with a capital, that is replaced as well, unless the text also uses
the word in lower case (Mr Brown, brown bread). A word's gender is that of most texts whose titles tell
one; it shows in the surrogate's ending alone. Initials (Dr J. Smith) and names without any title in
their text aren't found.

Distinct entities must get distinct surrogates, and no surrogate may be an entity of the corpus:
the distinct entities are checked for both in Spark, and those that fail get the surrogate of the
next attempt until none is left. Where the check finds nothing, which is the rule, the
texts are rewritten in the scan, without a shuffle; so they are with up to ``MOST_LATER`` entities that
have a later attempt or a gender that not every text tells: these go to the tasks as one constant.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwise.llm.common import free_name, written

#: Titles that mark the name after them, by the gender they tell ("n": none).
TITLES = {
    "m": ("Mr", "Herr", "Señor", "Monsieur", "Sir", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "Госпожа", "Κυρία"),
    "n": ("Dr", "Prof"),
}
#: Syllables that names are made of and the endings that tell gender, by script.
NAMES = {
    "latin": ("ba be bi bo da de di do fa fe ga ka ke ki la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi zo",
              "n r s k d rt l x", "a ia ina ella etta ora isa ana"),
    "cyrillic": ("ба ве ви га да де до зо ка ки ла ле ли ма ме ми мо на не ни ра ре ро са се ти то фе",
                 "н р с к д л м т", "а ия ина ена ова ика ара ана"),
    "greek": ("βα γα γε δα δε δι ζο θα θε κα κι κο λα λε λι μα με μι να νι ρα ρο σα στε τα τι φα φι",
              "ος ης ας ων ις ιος αιος ινος", "α η ια ινα ουλα ιδα ανα ενη"),
}
_TITLED = r"\b(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\b\.? "
_NAME = r"\p{Lu}(?:\p{L}{1,40}|(?=['\-]\p{Lu}))(?:['\-]\p{L}{2,40}){0,3}(?!\p{L})"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Kinds in the order in which they are tried at a place, and their patterns (Java).
PATTERNS = {
    "email": r"(?<![\p{L}\d._%+\-])[\p{L}\d._%+\-]{1,64}@[\p{L}\d\-]{1,63}(?:\.[\p{L}\d\-]{1,63}){1,8}",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){2,4}(?![\w])"
             r"|(?<![\w])\(\d{3}\) ?\d{3}[ .\-]\d{4}(?![\w])|(?<![\w.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\w\-])",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "iban": r"(?<![\w])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\w])",
    "card": r"(?<![\w.\-])\d{4}(?:[ \-]\d{4}){3}(?![\w\-])|(?<![\w.\-])\d{13,19}(?![\w\-])",
    "secret": r"(?<![\w])(?:AKIA[0-9A-Z]{16}|[0-9a-f]{32,64})(?![\w])",
    "name": _TITLED + _NAME + rf"(?: {_NAME}){{0,4}}",
}
PATTERN = "|".join(PATTERNS.values())
#: Most entities with a later attempt or a gender of their own that are sent to all tasks; more are joined.
MOST_LATER = 50_000
_BUCKETS = 4096
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets within which a letter is replaced.
ALPHABETS = (_LOWER, _UPPER, "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω")


def _lit(text: str) -> Column:
    return F.lit(text)


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once, as the one element of an array."""
    return F.transform(F.array(value), use)[0]


def kind_of(mention: Column) -> Column:
    """The kind whose pattern covers the whole mention."""
    out = None
    for kind, pattern in PATTERNS.items():
        if kind != "name":
            test = mention.rlike(f"^(?:{pattern})$")
            out = F.when(test, kind) if out is None else out.when(test, kind)
    return out.otherwise("name")


#: Country calling codes of one and two digits; all others have three.
_CODES = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"


def _phone(mention: Column) -> Column:
    """Digits of the country code, a bar and all digits; a number without a plus is one of country 1."""
    def build(digits):
        code = F.regexp_extract(digits, _CODES, 0)
        return F.concat(F.when(code != "", F.length(code)).otherwise(3).cast("string"), _lit("|"), digits)
    digits = F.regexp_replace(mention, r"\D", "")
    return _bind(F.when(mention.startswith("+"), digits).otherwise(F.concat(_lit("1"), digits)), build)


def _tokens(mention: Column) -> Column:
    """The name's words after the title."""
    return F.split(F.regexp_replace(mention, "^" + _TITLED, ""), " ")


def _gender(mention: Column) -> Column:
    tests = {g: mention.rlike(r"^(?:" + "|".join(TITLES[g]) + r")\b") for g in ("m", "f")}
    return F.when(tests["m"], "m").when(tests["f"], "f").otherwise("n")


def entities_of(mention: Column) -> Column:
    """Entities of a mention: one, but a name's words are one each. Array of (kind, norm)."""
    def build(kind):
        digits = F.regexp_replace(mention, r"\D", "")
        norm = (F.when(kind == "email", F.lower(mention))
                .when(kind == "phone", _phone(mention))
                .when(kind.isin("card", "ssn"), digits)
                .when(kind == "iban", F.regexp_replace(mention, r"\s", "")).otherwise(mention))
        names = F.transform(_tokens(mention), lambda w: F.struct(kind.alias("kind"), F.lower(w).alias("norm")))
        return F.when(kind == "name", names).otherwise(F.array(F.struct(kind.alias("kind"), norm.alias("norm"))))
    return _bind(kind_of(mention), build)


def _is_name(mention: Column) -> Column:
    """Only names begin with a title and a space."""
    return mention.rlike("^" + _TITLED)


def _people(found: Column, use) -> Column:
    """``use(said, role)`` with what a text's titled names tell: their words as they stand, and the role of a
    word in lower case: "m" or "f" if titles before it as a given name tell one gender alone, else "n"."""
    def told(words, gender):
        named = F.when(_gender(words) == gender, _tokens(words)).otherwise(F.array().cast("array<string>"))
        return F.transform(F.slice(named, 1, F.greatest(F.size(named) - 1, F.lit(0))), F.lower)

    def build(names):
        sets = F.struct(F.array_distinct(F.flatten(F.transform(names, _tokens))).alias("said"),
                        *[F.array_distinct(F.flatten(F.transform(names, lambda m: told(m, g)))).alias(g) for g in "mf"])

        def role(has):
            def of(norm):
                m, f = F.array_contains(has["m"], norm), F.array_contains(has["f"], norm)
                return F.when(m & ~f, "m").when(f & ~m, "f").otherwise("n")
            return of
        return _bind(sets, lambda has: use(has["said"], role(has)))
    return _bind(F.filter(found, _is_name), build)


def _number(digest: Column, i: Column) -> Column:
    """The i-th byte of a digest, again and again."""
    return F.conv(F.substring(digest, F.pmod(i, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _swapped(text: Column, digest: Column) -> Column:
    """Every digit and letter of a text replaced within its alphabet, the rest as it is."""
    def one(i):
        return _bind(F.struct(F.substring(text, i, F.lit(1)).alias("c"), _number(digest, i - 1).alias("n")),
                     lambda x: swap(x["c"], x["n"]))

    def swap(c, n):
        out = F.when(c.between("0", "9"), F.pmod(n, F.lit(10)).cast("string"))
        for letters in ALPHABETS:
            out = out.when(F.instr(F.lit(letters), c) > 0, F.substring(
                F.lit(letters), F.pmod(n, F.lit(len(letters))) + 1, F.lit(1)))
        return out.otherwise(F.when(c.rlike(r"\p{Lu}"), F.substring(F.lit(_UPPER), F.pmod(n, F.lit(26)) + 1, F.lit(1)))
                             .when(c.rlike(r"\p{L}"), F.substring(F.lit(_LOWER), F.pmod(n, F.lit(26)) + 1, F.lit(1)))
                             .otherwise(c))
    return F.when(F.length(text) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")).otherwise("")


def _luhn(digits: Column) -> Column:
    """Sum of a number's digits, every second from the right doubled, modulo ten."""
    def add(total, i):
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10


def _made_name(norm: Column, digest: Column, attempt: Column, role: Column) -> Column:
    """Four syllables, one more an attempt, in the script of the name, and an ending that tells the
    gender, or without one a syllable more."""
    def build(script):
        syllables, male, female = (F.split(F.lit(x), " ") for x in NAMES[script])
        pick = lambda options, i: F.element_at(options, F.pmod(_number(digest, i), F.size(options)) + 1)
        stem = F.array_join(F.transform(F.sequence(F.lit(2), attempt + 5), lambda i: pick(syllables, i)), "")
        end = F.when(role == "m", pick(male, F.lit(0))).when(role == "f", pick(female, F.lit(0))).otherwise(
            F.concat(pick(syllables, F.lit(0)), pick(male, F.lit(1))))
        return F.concat(stem, end)
    return F.when(norm.rlike(r"\p{IsCyrillic}"), build("cyrillic")).when(
        norm.rlike(r"\p{IsGreek}"), build("greek")).otherwise(build("latin"))


def surrogate_of(kind: Column, norm: Column, attempt: Column, key: str, role: Column | None = None) -> Column:
    """The surrogate of an entity, in normal form; ``role`` tells a name's gender (m, f, n)."""
    digest = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, norm, attempt.cast("string")).cast("binary"), 512)
    return _bind(digest, lambda d: _surrogate(kind, norm, d, attempt, F.lit("n") if role is None else role))


def _surrogate(kind: Column, norm: Column, digest: Column, attempt: Column, role: Column) -> Column:
    swapped = _swapped(norm, digest)
    domain = F.regexp_extract(norm, r"(\.[^.]*)$", 1)
    email = F.concat(_swapped(F.substring_index(norm, "@", 1), digest), F.lit("@"),
                     _swapped(F.regexp_extract(norm, r"@(.*)\.[^.]*$", 1), F.reverse(digest)), domain)
    ahead = F.substring_index(norm, "|", 1).cast("int")
    number = F.substring_index(norm, "|", -1)
    rest = F.substring(number, ahead + 1, F.length(number))
    phone = F.concat(F.substring_index(norm, "|", 1), F.lit("|"), F.substring(number, F.lit(1), ahead), _bind(
        rest, lambda r: F.when(F.substring(r, 1, 1) > "1", F.concat(
            (F.pmod(_number(digest, F.lit(63)), F.lit(8)) + 2).cast("string"),
            _swapped(F.substring(r, F.lit(2), F.length(r)), digest))).otherwise(_swapped(r, digest))))
    body = F.concat(F.substring(norm, 1, 1), _swapped(F.substring(norm, F.lit(2), F.length(norm) - 2), digest))
    card = _bind(body, lambda b: F.concat(b, F.when(_luhn(norm) == 0, F.pmod(10 - _luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast(
        "string")).otherwise(F.pmod(_number(digest, F.lit(63)), F.lit(10)).cast("string"))))
    ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (
        F.pmod(_number(digest, i), F.lit(254)) + 1).cast("string")), ".")
    kept = F.when(kind == "iban", 2).when(norm.startswith("AKIA"), 4).otherwise(0)
    hexed = F.array_join(F.transform(F.sequence(F.lit(1), F.length(norm)), lambda i: F.substring(
        F.lit("0123456789abcdef"), F.pmod(_number(digest, i - 1), F.lit(16)) + 1, F.lit(1))), "")
    return (F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "card", card).when(kind == "ip", ip)
            .when(kind == "ssn", swapped)
            .when((kind == "secret") & ~norm.startswith("AKIA"), hexed)
            .when(kind.isin("iban", "secret"), F.concat(F.substring(norm, F.lit(1), kept), _swapped(
                F.substring(norm, kept + 1, F.length(norm)), digest)))
            .otherwise(_made_name(norm, digest, attempt, role)))


def _laid_out(mention: Column, values: Column, slot: str) -> Column:
    """The characters of ``values`` in the places of the mention's slots, the rest of it as it is."""
    def one(i):
        c = F.substring(mention, i, F.lit(1))
        ahead = F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), f"[^{slot}]", ""))
        return F.when(c.rlike(f"[{slot}]"), F.substring(values, ahead, F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(mention)), one), "")


def rendered(mention: Column, surrogates: Column) -> Column:
    """The replacement of a mention: the surrogates of its entities in the mention's own format. They are
    bound: the formats name them seven times, and a copy each makes plans that the driver can't hold."""
    return _bind(surrogates, lambda made: _rendered(mention, made))


def _rendered(mention: Column, surrogates: Column) -> Column:
    def cased(first):
        def one(i):
            return _bind(F.substring(mention, i, F.lit(1)), lambda c: F.when(
                c != F.lower(c), F.upper(F.substring(first, i, F.lit(1)))).otherwise(F.substring(first, i, F.lit(1))))
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(mention)), one), "")

    def build(kind):
        first = surrogates[0]
        title = F.regexp_extract(mention, "^" + _TITLED, 0)
        digits = F.length(F.regexp_replace(mention, r"\D", ""))
        return (F.when(kind == "email", cased(first))
                .when(kind == "phone", _laid_out(mention, F.right(first, digits), "0-9"))
                .when(kind.isin("card", "ssn"), _laid_out(mention, first, "0-9"))
                .when(kind == "iban", _laid_out(mention, first, "A-Z0-9"))
                .when(kind == "name", F.concat(title, F.array_join(F.zip_with(_tokens(mention), surrogates, _cased_name), " ")))
                .otherwise(first))
    return _bind(kind_of(mention), build)


def _cased_name(word: Column, surrogate: Column) -> Column:
    return F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate))


def _mentions(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


#: Cheap sign that a text may hold an entity. Every match of ``PATTERNS`` holds one: a digit pair, two
#: digits about a dot (addresses of single digits), an at sign, the beginning of a key or a title.
_SIGN = r"\d\d|\d\.\d|@|AKIA|[0-9a-f]{32}|" + _TITLED


def corpus_entities(docs: DataFrame, found: Column) -> DataFrame:
    """kind, norm, role, mixed of every entity: a name's role as most texts tell it, and whether not all do."""
    def of_text(found):
        others = F.flatten(F.transform(F.filter(found, lambda m: ~_is_name(m)), lambda m: F.transform(
            entities_of(m), lambda e: F.struct(e["kind"].alias("kind"), e["norm"].alias("norm"), F.lit("n").alias("role")))))
        names = _people(found, lambda said, role: F.transform(F.array_distinct(F.transform(said, F.lower)), lambda w: F.struct(
            F.lit("name").alias("kind"), w.alias("norm"), role(w).alias("role"))))
        return F.concat(F.array_distinct(others), names)
    each = docs.select(F.explode(_bind(found, of_text)).alias("e")).select("e.*")
    n = {r: F.sum((F.col("role") == r).cast("long")) for r in "mfn"}
    role = F.when(F.col("m") > F.col("f"), "m").when(F.col("f") > F.col("m"), "f").otherwise("n")
    return each.groupBy("kind", "norm").agg(*[c.alias(r) for r, c in n.items()]).select(
        "kind", "norm", role.alias("role"), (F.greatest("m", "f", "n") < F.col("m") + F.col("f") + F.col("n")).alias("mixed"))


def resolve(entities: DataFrame, key: str) -> DataFrame:
    """kind, norm, attempt, role of the entities (kind, norm, role, mixed) that can't have their first
    surrogate, or whose role not every text tells.

    An attempt fails if its surrogate is an entity of that kind in the corpus, or also that of an
    entity that sorts before. Every round gives all that fail their next attempt and checks again.
    """
    state = written(entities.withColumn("attempt", F.lit(0)), "entities")
    while True:
        now = state.withColumn("surrogate", surrogate_of(F.col("kind"), F.col("norm"), F.col("attempt"), key, F.col("role")))
        same = Window.partitionBy("kind", "surrogate").orderBy(F.desc("is_entity"), "attempt", "norm")
        told = now.withColumn("is_entity", F.lit(0)).unionByName(state.select(
            "kind", "norm", "role", "mixed", F.lit(0).alias("attempt"), F.col("norm").alias("surrogate"), F.lit(1).alias("is_entity")))
        checked = told.withColumn("place", F.row_number().over(same)).where("is_entity = 0")
        after = written(checked.select("kind", "norm", "role", "mixed", (F.col("attempt") + (F.col("place") > 1).cast("int")).alias(
            "attempt"), (F.col("place") > 1).alias("failed")), "entities")
        state = after.drop("failed")
        if after.where("failed").isEmpty():
            return state.where("attempt > 0 OR mixed").select("kind", "norm", "attempt", "role")


_LATER = "struct<attempt:int,role:string>"


def _key_of(kind: Column, norm: Column) -> Column:
    return F.concat_ws("|", kind, norm)


def _constant(later: DataFrame) -> Column:
    """At most ``MOST_LATER`` entities as a constant: an array of maps, an entity in that of its hash."""
    key = _key_of(F.col("kind"), F.col("norm"))
    maps = [{} for _ in range(_BUCKETS)]
    for r in later.select(key.alias("key"), F.pmod(F.xxhash64(key), F.lit(_BUCKETS)).alias("at"), "attempt", "role").collect():
        maps[r["at"]][r["key"]] = {"attempt": r["attempt"], "role": r["role"]}
    return F.from_json(F.lit(json.dumps(maps, ensure_ascii=False)), f"array<map<string,{_LATER}>>")


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n_replaced of every row: the text with surrogates in place of its entities.

    Null texts stay null with n_replaced 0, empty ones empty. Repeated rows get equal texts, rows with null
    ids are rewritten like others; an empty table gives no rows; other columns are ignored. An entity
    is what one of ``PATTERNS`` matches, the first kind that does at a place, or a word of a name said again.
    One text with k names costs k comparisons at each of its capitalised words.
    """
    return rewrite(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), key).select(
        "doc_id", "text", "n_replaced")


def rewrite(docs: DataFrame, key: str, count_col: str = "n_replaced") -> DataFrame:
    """``docs`` with its column text rewritten and the number of replacements beside it."""
    text = F.col("text")
    found_col, later_col, key_col, names_col, loose_col = (
        free_name([*docs.columns, count_col], c) for c in ("_found", "_later", "_key", "_names", "_loose"))
    none = F.array().cast("array<string>")
    found = F.coalesce(F.when(text.rlike(_SIGN), _mentions(text)), none)
    later = resolve(corpus_entities(docs, found), key)
    n_later = later.limit(MOST_LATER + 1).count()
    # a generator, so that what it finds is found once and not again for every use
    rows = docs.select("*", F.inline(F.array(F.struct(found.alias(found_col)))))
    if not n_later:
        told = lambda kind, norm: F.lit(None).cast(_LATER)
    elif n_later <= MOST_LATER:
        table = _constant(later)
        told = lambda kind, norm: F.try_element_at(F.element_at(
            table, F.pmod(F.xxhash64(_key_of(kind, norm)), F.lit(_BUCKETS)).cast("int") + 1), _key_of(kind, norm))
    else:  # the entities meet the texts that hold them
        holds = docs.select("text", F.explode(found).alias("mention")).select(
            F.sha2("text", 256).alias(key_col), F.explode(entities_of(F.col("mention"))).alias("e"))
        maps = holds.select(key_col, "e.kind", "e.norm").distinct().join(later, ["kind", "norm"]).groupBy(key_col).agg(
            F.map_from_entries(F.collect_list(F.struct(_key_of(F.col("kind"), F.col("norm")), F.struct("attempt", "role")))).alias(later_col))
        # texts without an entity get keys of their own, so they don't meet in one task
        own = F.concat(F.lit("-"), F.xxhash64("text").cast("string"))
        rows = rows.withColumn(key_col, F.when(F.size(found_col) > 0, F.sha2("text", 256)).otherwise(own)).join(
            written(maps, "attempts"), key_col, "left").drop(key_col)
        told = lambda kind, norm: F.try_element_at(F.col(later_col), _key_of(kind, norm))

    def made(kind, norm, role):
        return _bind(told(kind, norm), lambda t: surrogate_of(
            kind, norm, F.coalesce(t["attempt"], F.lit(0)), key, F.coalesce(t["role"], role)))

    def people(said, role):
        """Surrogates of the words of a text's names, and the pattern of those that are replaced without a title."""
        norms = F.array_distinct(F.transform(said, F.lower))
        names = F.map_from_entries(F.transform(norms, lambda w: F.struct(w, made(F.lit("name"), w, role(w)))))
        common = F.when(F.size(said) > 0, F.regexp_extract_all(text, F.lit(r"(?<![\p{L}\p{N}])\p{Ll}[\p{L}'\-]*"), F.lit(0)))
        proper = F.filter(said, lambda w: ~F.array_contains(F.array_intersect(norms, common), F.lower(w)))
        forms = F.array_distinct(F.concat(proper, F.transform(proper, F.upper), F.transform(proper, F.initcap)))
        longest = F.reverse(F.array_sort(F.transform(forms, lambda w: F.struct(F.length(w), w.alias("w")))))
        loose = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?=\p{Lu})(?:"), F.array_join(longest["w"], "|"), F.lit(r")(?![\p{L}\p{N}])"))
        return F.struct(names.alias(names_col), F.when(F.size(proper) > 0, loose).alias(loose_col))

    rows = rows.select("*", F.inline(F.array(_people(F.col(found_col), people))))
    names, loose = F.col(names_col), F.col(loose_col)
    replaced = F.transform(found_col, lambda m: rendered(m, F.when(_is_name(m), F.transform(
        _tokens(m), lambda w: F.element_at(names, F.lower(w)))).otherwise(
        F.transform(entities_of(m), lambda e: made(e["kind"], e["norm"], F.lit("n"))))))

    def put_in(between: Column, new: Column) -> Column:
        return _bind(new, lambda put: F.concat(between[0], F.array_join(F.zip_with(
            put, F.slice(between, 2, F.size(put)), lambda r, b: F.concat(r, b)), "")))

    def renamed(part: Column) -> Column:
        """A part between mentions, with the names said there without a title replaced."""
        said = F.transform(F.regexp_extract_all(part, loose, F.lit(0)), lambda w: _cased_name(w, F.element_at(names, F.lower(w))))
        return F.when(loose.isNull(), part).otherwise(put_in(F.split(part, loose, -1), said))

    # the parts between entities are bound once, as the one element of an array
    parts = F.split(text, PATTERN, -1)
    whole = _bind(parts, lambda between: put_in(F.transform(between, renamed), replaced))
    again = F.when(loose.isNull(), 0).otherwise(F.aggregate(parts, F.lit(0), lambda n, part: n + F.regexp_count(part, loose)))
    return rows.withColumns({count_col: F.size(found_col) + again, "text": F.when(F.size(found_col) > 0, whole).otherwise(text)}).drop(
        found_col, later_col, names_col, loose_col)
