"""Personal data replaced by keyed surrogates of the same type, script and format.

Detection is one regular expression; every distinct entity of the corpus gets one surrogate, drawn
from a hash of the key and the entity's normal form, so mentions of one entity stay the same in all
documents, however they are written. A surrogate that another entity has, or that is itself an
entity of the corpus, is drawn again until all are distinct. Everything is SQL expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "г-жа")
KEY_MARKS = ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-")
_TITLE = "(?:" + "|".join(MALE + FEMALE) + r")\.? "
#: Type and pattern, the first that matches counts.
KINDS = (
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]+\.)+\p{L}{2,}"),
    ("secret", r"(?<!\w)(?:(?=[a-f]*[0-9])[0-9a-f]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,})(?!\w)"),
    ("ip", rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("phone", r"(?<!\w)(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)"),
    ("phone", r"(?<!\w)\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)"),
    ("card", r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)"),
    ("iban", r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)"),
    ("name", rf"(?<!\w){_TITLE}\p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?"),
)
PATTERN = "|".join(f"(?:{p})" for _, p in KINDS)
#: Letters a letter is replaced from, by script; others with accents become plain ones of their case.
_ALPHABETS = (
    ("[0-9]", "0123456789"),
    ("[a-z]", "abcdefghijklmnopqrstuvwxyz"),
    ("[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (r"[\p{IsCyrillic}&&\p{Ll}]", "абвгдежзиклмнопрстуфхцчшэюя"),
    (r"[\p{IsCyrillic}&&\p{Lu}]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    (r"[\p{IsGreek}&&\p{Ll}]", "αβγδεζηθικλμνξοπρστυφχψω"),
    (r"[\p{IsGreek}&&\p{Lu}]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    (r"\p{Lu}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (r"\p{L}", "abcdefghijklmnopqrstuvwxyz"),
)
# Syllables of invented names, Latin and Cyrillic, and endings by gender.
SYLLABLES = ("ba", "ce", "di", "fo", "ga", "he", "ji", "ko", "la", "me", "ni", "po", "ra", "se", "ti", "vo")
CYRILLIC = ("ба", "ве", "ги", "до", "жа", "зе", "ки", "ло", "ма", "не", "пи", "ро", "са", "те", "фи", "хо")
ENDINGS = {("male", False): "rt", ("female", False): "na", ("male", True): "слав", ("female", True): "на"}


def may_hold_entity(text: Column) -> Column:
    """Cheap and true of every text that holds one: a pattern needs a digit, an @, a title or the mark of a key."""
    named = [F.contains(text, F.lit(part)) for part in MALE + FEMALE + KEY_MARKS]
    return reduce(lambda a, b: a | b, named, text.rlike("[0-9@]"))


def kind_of(entity: Column) -> Column:
    """Type of a matched string."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def normal_form(kind: Column, entity: Column) -> Column:
    """What makes two mentions the same entity: letters without case and digits; an address keeps its signs."""
    plain = F.lower(F.regexp_replace(entity, r"[^\p{L}\p{N}]", ""))
    name = F.regexp_replace(entity, f"^{_TITLE}", "")
    return F.when(kind.isin("email", "ip"), F.lower(entity)).when(kind == "name", name).otherwise(plain)


def _bits(seed: Column, step: Column | int) -> Column:
    """A non-negative number for each step; ``seed`` is a keyed SHA-256 in hexadecimal."""
    step = F.lit(step) if isinstance(step, int) else step
    return F.shiftrightunsigned(F.xxhash64(seed, step.cast("int")), 2)


def _pick(seed: Column, step: Column | int, signs: str) -> Column:
    return F.substring(F.lit(signs), (_bits(seed, step) % len(signs)).cast("int") + 1, F.lit(1))


def _same_shape(value: Column, seed: Column) -> Column:
    """Every letter and digit replaced by one of its script and case, numbered without the other signs."""
    signs = F.split(value, "")
    number = lambda at: F.length(F.regexp_replace(F.substring(value, F.lit(1), at), r"[^\p{L}\p{N}]", ""))

    def one(sign: Column, at: Column) -> Column:
        out = sign
        for pattern, alphabet in reversed(_ALPHABETS):
            out = F.when(sign.rlike(f"^{pattern}$"), _pick(seed, number(at + 1), alphabet)).otherwise(out)
        return out

    return F.array_join(F.transform(signs, one), "")


def _check_digit(digits: Column, doubled_first: bool) -> Column:
    """Sum of the card rule over a string of digits, from the right."""
    turned = F.split(F.reverse(digits), "")

    def worth(sign: Column, at: Column) -> Column:
        value = sign.cast("int") * (1 + ((at + (1 if doubled_first else 0)) % 2))
        return F.when(value > 9, value - 9).otherwise(value)

    return F.aggregate(F.transform(turned, worth), F.lit(0), lambda total, x: total + x)


def _card(entity: Column, seed: Column) -> Column:
    """Digits replaced; the last one makes the number pass the card rule exactly if the given one does."""
    shape = _same_shape(entity, seed)
    valid = _check_digit(F.regexp_replace(entity, "[^0-9]", ""), False) % 10 == 0
    body = F.regexp_replace(F.regexp_replace(shape, "[^0-9]", ""), ".$", "")
    right = (10 - _check_digit(body, True) % 10) % 10
    wrong = (right + 1 + _bits(seed, 99) % 9) % 10
    return F.concat(F.regexp_replace(shape, ".$", ""), F.when(valid, right).otherwise(wrong).cast("string"))


def _name(entity: Column, seed: Column, key: Column, tries: Column) -> Column:
    """Invented names of the title's gender and of the script; a surname depends on the surname only."""
    title = F.regexp_extract(entity, f"^({_TITLE})", 1)
    words = F.split(F.regexp_replace(entity, f"^{_TITLE}", ""), " ")
    cyrillic = F.element_at(words, 1).rlike(r"\p{IsCyrillic}")
    female = F.regexp_replace(title, r"\.? $", "").isin(*FEMALE)

    def made(word: Column, count: int) -> Column:
        own = F.sha2(F.concat_ws("|", key, F.lit("name"), word, tries.cast("string")), 256)
        parts = []
        for k in range(count):
            at = (_bits(own, k) % len(SYLLABLES)).cast("int") + 1
            latin, other = (F.element_at(F.array(*map(F.lit, s)), at) for s in (SYLLABLES, CYRILLIC))
            parts.append(F.when(cyrillic, other).otherwise(latin))
        return F.concat(*parts)

    def ending() -> Column:
        pick = lambda c: F.when(female, ENDINGS["female", c]).otherwise(ENDINGS["male", c])
        return F.when(cyrillic, pick(True)).otherwise(pick(False))

    surname = F.initcap(made(F.element_at(words, -1), 4))
    given = F.initcap(F.concat(made(F.element_at(words, 1), 2), ending()))
    return F.concat(title, F.when(F.size(words) > 1, F.concat_ws(" ", given, surname)).otherwise(surname))


def surrogate(kind: Column, entity: Column, normal: Column, key: str, tries: Column) -> Column:
    """Replacement of a mention; later tries differ, and from the fourth on addresses and secrets grow longer."""
    secret = F.lit(key)
    seed = F.sha2(F.concat_ws("|", secret, kind, normal, tries.cast("string")), 256)
    longer = F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(tries - 3, F.lit(0))), lambda k: F.when(
        k > 0, _pick(seed, k + 200, "abcdefghijklmnopqrstuvwxyz")).otherwise("")), "")
    host = F.regexp_extract(entity, r"@([^.]+)\.", 1)
    ending = F.regexp_extract(F.lower(entity), r"\.(com|org|net)$", 1)
    email = F.concat(
        _same_shape(F.regexp_extract(entity, "^([^@]+)@", 1), seed), longer, F.lit("@"),
        _same_shape(host, F.sha2(F.concat_ws("|", secret, F.lower(host)), 256)),
        F.lit(".example."), F.when(ending == "", "com").otherwise(ending),
    )
    ip = F.concat_ws(
        ".", *((F.lit(240 if k == 0 else 0) + _bits(seed, k) % (16 if k == 0 else 256)).cast("string") for k in range(4))
    )
    hexa = F.array_join(
        F.transform(F.split(entity, ""), lambda c, at: _pick(seed, at, "0123456789abcdef")), ""
    )
    start = _prefix(entity)
    rest = F.substring(entity, F.length(start) + 1, F.length(entity))
    shaped = F.concat(start, _same_shape(rest, seed))
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", _card(entity, seed)).when(
        kind == "ssn", F.concat(F.lit("9"), F.substring(_same_shape(entity, seed), 2, 100))
    ).when(kind == "name", _name(entity, seed, secret, tries)).when(
        (kind == "secret") & (start == ""), F.concat(hexa, longer)
    ).otherwise(shaped)


def _prefix(entity: Column) -> Column:
    """Leading part that belongs to the format: country codes and the marks of keys."""
    return F.regexp_extract(entity, r"^(AKIA|gh[pousr]_|sk-|\+\d{1,3}(?=\D)|[A-Z]{2}(?=\d{2}))", 1)


def entity_table(mentions: DataFrame, key: str) -> DataFrame:
    """(entity, kind, normal, surrogate) of all distinct mentions; distinct entities have distinct surrogates.

    The normal forms are settled in rounds: of the entities that draw the same surrogate the first
    keeps it, and none keeps one that is an entity itself or was given before; the rest draw again.
    """
    kind = kind_of(F.col("entity"))
    known = settle(
        mentions.select("entity").distinct().withColumn("kind", kind)
        .withColumn("normal", normal_form(F.col("kind"), F.col("entity")))
    )
    # One way of writing stands for an entity while surrogates are drawn.
    open_ = known.groupBy("kind", "normal").agg(F.min("entity").alias("entity"))
    real = known.select("kind", F.col("normal").alias("drawn")).distinct()
    given, tries = None, 0
    while True:
        out = surrogate(F.col("kind"), F.col("entity"), F.col("normal"), key, F.lit(tries))
        drawn = settle(open_.withColumn("drawn", normal_form(F.col("kind"), out)))
        taken = real if given is None else real.unionByName(given.select("kind", "drawn"))
        free = drawn.join(taken, ["kind", "drawn"], "left_anti")
        firsts = free.groupBy("kind", "drawn").agg(F.min("normal").alias("normal"))
        won = settle(firsts.withColumn("tries", F.lit(tries)))
        given = won if given is None else given.unionByName(won)
        rest = drawn.drop("drawn").join(won.select("kind", "normal"), ["kind", "normal"], "left_anti")
        open_ = settle(rest)
        if open_.isEmpty():
            break
        tries += 1
    settled = known.join(given.select("kind", "normal", "tries"), ["kind", "normal"])
    text = surrogate(F.col("kind"), F.col("entity"), F.col("normal"), key, F.col("tries"))
    return settle(settled.select("entity", "kind", "normal", text.alias("surrogate")))


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text`` and ``n_entities`` (bigint), the mentions replaced.

    Documents without a mention, null and empty texts pass as they are, with 0. Copies and repeated
    rows get the same replacement. Columns ``n_entities`` of the input are replaced, others kept.
    """
    kept = [c for c in docs.columns if c.lower() != "n_entities"]
    text = F.col("text")
    hit = F.coalesce(F.when(may_hold_entity(text), text.rlike(PATTERN)), F.lit(False))
    plain = docs.filter(~hit).select(*kept, F.lit(0).cast("bigint").alias("n_entities"))
    text_key = [F.xxhash64("text").alias("_a"), F.xxhash64(F.lit(1), "text").alias("_b")]
    found = docs.filter(hit)
    mentions = settle(
        found.select(*text_key, F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))))
        .withColumnRenamed("col", "entity")
        .distinct()
    )
    table = entity_table(mentions, key).select("entity", "surrogate")
    by_text = settle(
        mentions.join(table, "entity")
        .groupBy("_a", "_b")
        .agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("_map"))
    )
    parts = F.split("text", PATTERN, -1)
    matches = F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))
    joined = F.array_join(
        F.transform(
            F.arrays_zip(parts.alias("part"), matches.alias("match")),
            lambda x: F.concat(x["part"], F.coalesce(F.element_at("_map", x["match"]), F.lit(""))),
        ),
        "",
    )
    replaced = found.select(*kept, *text_key).join(by_text, ["_a", "_b"])
    new = {"text": joined}
    return replaced.select(
        *(new[c].alias(c) if c in new else F.col(c) for c in kept), F.size(matches).cast("bigint").alias("n_entities")
    ).unionByName(plain)
