"""Surrogates for personal data, in DataFrame and SQL functions only.

Entities are found with one pattern; each gets a replacement of its kind, made from a keyed hash of its canonical form, so
one entity has one replacement in all documents and formats. Formats, scripts, letter case and the gender of a title are
kept; cards and account numbers get right check digits, addresses lie in reserved ranges or names.

The distinct entities are one aggregation. Replacements that two entities share, or that are entities of the corpus
themselves, are made anew with the next attempt until none is left, so different entities stay different. Mentions are
joined to the table of replacements by plain rows, and go back to their documents in order; only documents with mentions
are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.llm.repeats import row_key
from tabweave.session import written

#: Titles by gender, and given names and parts of family names by script.
MALE = "Mr Herr Monsieur Señor Sr Signor господин г-н".split()
FEMALE = "Mrs Ms Miss Frau Madame Mme Mlle Señora Sra Signora госпожа г-жа".split()
GIVEN = {
    "latin_m": "Adam Brian Carl Daniel Emil Felix George Henry Ivan James Karl Louis Martin Oscar Paul Victor".split(),
    "latin_f": "Alice Bella Clara Diana Emma Flora Grace Helen Irene Julia Laura Maria Nora Olivia Rosa Sofia".split(),
    "cyrillic_m": "Андрей Борис Виктор Глеб Денис Егор Захар Игорь Кирилл Лев Максим Никита Олег Павел Роман Тимур".split(),
    "cyrillic_f": "Алиса Белла Вера Галина Дарья Елена Зоя Ирина Ксения Лидия Мария Нина Ольга Полина Рита Софья".split(),
}
PARTS = {
    "latin": "bar ben cor dal dor fen gal har jor kel lan mar nel nor per ral ros sel tam ver vin wal wes zan".split(),
    "cyrillic": "бар бел вал вер гор дан дор ел жар зим кал кор лан лес мал мир нов ол пет рог сем тар фед ян".split(),
}
#: Attempts from which a replacement is longer or leaves its first range, and from which its format gives way.
EARLY, LATE = 6, 12
ENDINGS = {"latin_m": "", "latin_f": "", "cyrillic_m": "ов", "cyrillic_f": "ова"}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: A word of a name, without the s of a possessive.
_NAME = r"\p{Lu}(?:\p{L}|['’-](?!s(?!\p{L}))(?=\p{L}))+"
_TITLE = "(?:" + "|".join(MALE + FEMALE) + r")\.?"
#: Kind, pattern, what may not or must stand before and after. The first that fits counts.
KINDS = [
    ("email", r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}+", r"(?<![A-Za-z0-9._%+-])", r"(?![A-Za-z0-9])"),
    ("ip", rf"{_OCTET}(?:\.{_OCTET}){{3}}", r"(?<![\w.])", r"(?!\w|\.\d)"),
    ("ssn", r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}", r"(?<![\w-])", r"(?![\w-])"),
    ("phone", r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{4}|\+\d{1,3}(?:[ .-]\d{2,4}){3,5}|\+\d{9,14}", r"(?<![\w+.-])", r"(?![\w-])"),
    ("card", r"\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19}", r"(?<![\w.-])", r"(?![\w-]|\.\d)"),
    ("iban", r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?", r"(?<![\w])", r"(?!\w)"),
    ("secret", r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}+", r"(?<![\w-])", r"(?!\w)"),
    (
        "secret",
        r"(?=[A-Za-z+/_-]*\d)[A-Za-z0-9+/_-]{8,}+=*",
        r"(?<![A-Za-z0-9+/_-])(?<=(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)",
        "",
    ),
    ("name", rf"{_TITLE} (?:(?:\p{{Lu}}\.|{_NAME}) )*{_NAME}", r"(?<![\p{L}\p{N}])", ""),
]
#: A text without any of these holds no entity.
HINT = rf"[0-9@]|AKIA|ASIA|sk-|gh[pousr]_|(?<!\p{{L}}){_TITLE} \p{{Lu}}"


def _renumbered(pattern: str) -> str:
    """The pattern for use beside others: its back references by name."""
    return pattern.replace("([ -]?)", "(?<gap>[ -]?)").replace(r"\1", r"\k<gap>")


PATTERN = "|".join(f"{before}(?:{_renumbered(core)}){after}" for _, core, before, after in KINDS)


def _lit(values: list[str]) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in values) + ")"


def kind_of(entity: Column) -> Column:
    """Kind of a match; what fits no other kind was found by what stands before it."""
    out = None
    for kind, core, _, _ in KINDS:
        test = F.regexp_like(entity, F.lit(f"^(?:{core})$"))
        out = F.when(test, kind) if out is None else out.when(test, kind)
    return out.otherwise("secret")


def luhn_sum(digits: str) -> str:
    """SQL for the check sum of a digit string, from its last digit."""
    digit = f"cast(substring({digits}, length({digits}) - i + 1, 1) AS int)"
    return f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + IF(i % 2 = 1, {digit}, {digit} * 2 - IF({digit} > 4, 9, 0)))"


def iban_rest(text: str) -> str:
    """SQL for an account number with its first four characters moved behind, modulo 97."""
    turned = f"concat(substring({text}, 5), substring({text}, 1, 4))"
    value = "IF(ascii(c) >= 65, ascii(c) - 55, ascii(c) - 48)"
    return f"aggregate(filter(split({turned}, ''), c -> c <> ''), 0, (s, c) -> (s * IF(ascii(c) >= 65, 100, 10) + {value}) % 97)"


def canonical(kind: Column, entity: Column) -> Column:
    """What mentions of one entity have in common."""
    name = F.concat_ws("|", F.when(F.regexp_like(entity, F.lit("^(?:" + "|".join(FEMALE) + r")\.? ")), "f").otherwise("m"), F.regexp_replace(entity, rf"^{_TITLE} ", ""))
    return (
        F.when(kind == "email", F.lower(entity))
        .when(kind == "name", name)
        .when(kind.isin("phone", "card", "ssn", "iban"), F.regexp_replace(entity, "[^0-9A-Za-z]", ""))
        .otherwise(entity)
    )


def _byte(i: str, h: str = "h") -> str:
    return f"cast(conv(substring({h}, 2 * (({i}) % 64) + 1, 2), 16, 10) AS int)"


def _alike(text: str, shift: int = 0, h: str = "h", letters: int = 26) -> str:
    """SQL: every digit and letter of a text replaced by another of its kind, from the first `letters` of the alphabet."""
    c, b = f"substring({text}, i, 1)", _byte(f"i + {shift}", h)
    each = f"CASE WHEN {c} RLIKE '[0-9]' THEN cast({b} % 10 AS string) WHEN {c} RLIKE '[a-z]' THEN char(97 + {b} % {letters}) WHEN {c} RLIKE '[A-Z]' THEN char(65 + {b} % {letters}) ELSE {c} END"
    return f"IF(length({text}) = 0, '', array_join(transform(sequence(1, greatest(1, length({text}))), i -> {each}), ''))"


def replacement(key: str, shared: str = "0") -> Column:
    """Replacement in canonical form, from columns kind, canon and attempt; `shared` is the attempt of its family name or domain."""

    def hashed(what: str, attempt: str = "attempt") -> str:
        parts = f"concat_ws('|', '{key}', kind, {what}, cast({attempt} AS string)"
        return f"concat(sha2({parts}, '0'), 256), sha2({parts}, '1'), 256))"

    h = hashed("canon")
    domain, local = "substring_index(canon, '@', -1)", "substring_index(canon, '@', 1)"
    labels = f"substring({domain}, 1, length({domain}) - length(substring_index({domain}, '.', -1)) - 1)"
    # Every kind has more replacements the more attempts it takes: longer ones, or where the format fixes the length, with
    # letters for digits, so that different entities get different ones however many there are.
    more = {h: "concat(" + ", ".join(f"char(97 + {_byte(str(k), h)} % 26)" for k in range(50, 56)) + ")" for h in ("h", "dh")}
    longer = {h: f"IF({a} < {EARLY}, '', {more[h]})" for h, a in (("h", "attempt"), ("dh", shared))}
    email = f"concat({_alike(local)}, {longer['h']}, '@', {_alike(labels, 0, 'dh')}, {longer['dh']}, '.example')"
    octets = ", ".join(f"cast({_byte(str(k))} AS string)" for k in range(3))
    wide = ", ".join(f"substring(h, {4 * k + 1}, 4)" for k in range(6))
    ip = f"CASE WHEN attempt < {EARLY} THEN concat_ws('.', '10', {octets}) WHEN attempt < {LATE} THEN concat_ws('.', cast(240 + {_byte('3')} % 16 AS string), {octets}) ELSE concat_ws(':', '2001', 'db8', {wide}) END"
    lettered = f"array_join(transform(sequence(1, length(canon)), i -> char(97 + {_byte('i')} % 26)), '')"
    body = f"concat(substring(canon, 1, 1), substring({_alike('canon')}, 2, length(canon) - 2))"
    card = f"concat({body}, cast((10 - {luhn_sum(f'concat({body}, 0)')} % 10) % 10 AS string))"
    far = "greatest(0, length(canon) - 10)"
    digit = f"IF(i <= {far}, substring(canon, i, 1), cast(IF(i - {far} IN (1, 4), 2 + {_byte('i')} % 8, {_byte('i')} % 10) AS string))"
    phone = f"array_join(transform(sequence(1, length(canon)), i -> {digit}), '')"
    ssn = f"concat('9', substring({_alike('canon')}, 2))"
    raw = f"concat(substring(canon, 1, 2), '00', substring({_alike('canon')}, 5))"
    iban = f"concat(substring(canon, 1, 2), lpad(cast(98 - {iban_rest(raw)} AS string), 2, '0'), substring({raw}, 5))"
    prefix = r"regexp_extract(canon, '^(AKIA|ASIA|gh[pousr]_|sk-)', 1)"
    phone, card, ssn, iban = (f"IF(attempt < {LATE}, {v}, {lettered})" for v in (phone, card, ssn, iban))
    secret = f"IF(canon RLIKE '^[0-9a-f]+$', {_alike('canon', letters=6)}, concat({prefix}, substring({_alike('canon')}, length({prefix}) + 1)))"
    secret = f"concat({secret}, {longer['h']})"
    person = "substring(canon, 3)"
    latin = f"NOT ({person} RLIKE '\\\\p{{IsCyrillic}}')"
    given, family = f"IF({person} LIKE '% %', substring_index({person}, ' ', 1), '')", f"substring_index({person}, ' ', -1)"
    cases = []
    for script, condition in (("latin", latin), ("cyrillic", f"NOT ({latin})")):
        for sex in "mf":
            names, parts = _lit(GIVEN[f"{script}_{sex}"]), _lit(PARTS[script])
            made = _joined(parts, len(PARTS[script]), 4, 0, shared, "fh")
            own = _joined(parts, len(PARTS[script]), 3, 9, "attempt", "h")
            first = f"IF({given} = '', '', concat(IF(attempt < {EARLY}, element_at({names}, 1 + {_byte('8', 'h')} % {len(GIVEN[f'{script}_{sex}'])}), {own}), ' '))"
            cases.append(f"WHEN {condition} AND canon LIKE '{sex}|%' THEN concat({first}, {made}, '{ENDINGS[f'{script}_{sex}']}')")
    name = "CASE " + " ".join(cases) + " END"
    kinds = {"email": email, "ip": ip, "card": card, "phone": phone, "ssn": ssn, "iban": iban, "secret": secret, "name": name}
    whole = "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in kinds.items()) + " END"
    # The hashes are bound once, as variables of a function over a one-element array.
    return F.expr(f"element_at(transform(array(struct({h} AS h, {hashed(domain, shared)} AS dh, {hashed(family, shared)} AS fh)), v -> {_bound(whole)}), 1)")


def _joined(parts: str, n: int, least: int, first: int, attempt: str, h: str) -> str:
    """SQL: a name of `least` parts, and of one more with every third attempt."""
    return f"initcap(array_join(transform(sequence(1, {least} + cast({attempt} AS int) div 3), i -> element_at({parts}, 1 + {_byte(f'i + {first - 1}', h)} % {n})), ''))"


def _bound(sql: str) -> str:
    for name in ("dh", "fh", "h"):
        sql = sql.replace(f"substring({name}, ", f"substring(v.{name}, ")
    return sql


def _settled(base: DataFrame, made: Column) -> DataFrame:
    """`base` with attempt and made, such that no two rows of a kind (and title) share one and none is real.

    A row that shares its replacement with another of the same round (but for the first), with a settled one or with an
    entity tries again; only such rows are made anew. Replacements grow with the attempts, so the rounds end.
    """
    title = F.when(F.col("kind") == "name", F.substring("canon", 1, 2)).otherwise("").alias("title")
    own = F.when(F.col("kind") == "name", F.substring("canon", 3, 1 << 30)).otherwise(F.col("canon"))
    real = written(base.select("kind", own.alias("made"), F.lit(True).alias("real")).distinct(), "entities")
    now, done = base, None
    while True:
        tried = written(now.withColumn("made", made).select("*", title), "replacements")
        first = tried.groupBy("kind", "title", "made").agg(F.min("canon").alias("first"))
        judged = tried.join(first, ["kind", "title", "made"]).join(real, ["kind", "made"], "left")
        again = F.col("real").isNotNull() | (F.col("first") != F.col("canon"))
        if done is not None:
            judged = judged.join(done.select("kind", "title", "made", F.lit(True).alias("taken")), ["kind", "title", "made"], "left")
            again = again | F.col("taken").isNotNull()
        judged = written(judged.select(*tried.columns, again.alias("again")), "judged")
        good = judged.where("NOT again").drop("again")
        done = good if done is None else done.unionByName(good)
        now = judged.where("again").select(*[F.col("attempt") + 1 if c == "attempt" else F.col(c) for c in base.columns]).toDF(*base.columns)
        if now.isEmpty():
            return done.drop("title")


def distinct_replacements(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, made): one replacement for each entity, none shared (but by titles, which stay), none an entity itself.

    Family names and domains are settled first, by themselves: whoever shares one goes on sharing it.
    """
    base = entities.groupBy("kind", "canon").agg(F.lit(0).alias("attempt"))
    last = F.when(F.col("kind") == "name", F.concat(F.lit("m|"), F.substring_index(F.substring("canon", 3, 1 << 30), " ", -1))).when(F.col("kind") == "email", F.concat(F.lit("x@"), F.substring_index("canon", "@", -1)))
    base = written(base.withColumn("part", last), "entities")
    parts = base.where("part IS NOT NULL").select("kind", F.col("part").alias("canon")).distinct().withColumn("attempt", F.lit(0))
    # All domains are judged by themselves: the part before the @ is the same for all.
    alone = F.when(F.col("kind") == "email", F.concat(F.lit("x@"), F.substring_index(replacement(key, "attempt"), "@", -1))).otherwise(replacement(key, "attempt"))
    settled = _settled(written(parts, "shared-parts"), alone).select("kind", F.col("canon").alias("part"), F.col("attempt").alias("part_attempt"))
    base = base.join(settled, ["kind", "part"], "left").select("kind", "canon", "attempt", F.coalesce("part_attempt", F.lit(0)).alias("part_attempt"))
    return _settled(written(base, "entities"), replacement(key, "part_attempt")).select("kind", "canon", "made")


def poured(kind: Column, entity: Column, made: Column) -> Column:
    """A replacement in the format of a mention."""
    filled = F.expr(
        "array_join(transform(sequence(1, length(entity)), i -> IF(substring(entity, i, 1) RLIKE '[0-9A-Za-z]', "
        "substring(made, length(regexp_replace(substring(entity, 1, i), '[^0-9A-Za-z]', '')), 1), substring(entity, i, 1))), '')"
    )
    title = F.regexp_extract(entity, rf"^({_TITLE} )", 1)
    return F.when(kind.isin("phone", "card", "ssn", "iban"), filled).when(kind == "name", F.concat(title, made)).otherwise(made)


def replace_entities(docs: DataFrame, doc: str = "doc_id", text: str = "text", key: str = "surrogates-1") -> DataFrame:
    """All rows and columns of `docs` with entities in the text replaced, and `n_entities` added.

    A null text stays null, an empty one empty, both with 0 entities; texts without entities are returned byte by byte.
    Numbers like cards without a right check digit are no cards and stay. Repeated rows have equal results. A column called
    `n_entities` is replaced. `key` names the secret that the hashes depend on.
    """
    # The row travels as one value, so that no name of its columns can clash.
    rows = docs.select(row_key(docs, doc, text).alias("key"), docs[text].cast("string").alias("body"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    hinted = F.coalesce(F.regexp_like("body", F.lit(HINT)), F.lit(False))
    plain, candidates = rows.where(~hinted), rows.where(hinted)
    old = F.regexp_extract_all("body", F.lit(PATTERN), F.lit(0))
    found = candidates.select("key", F.posexplode(old).alias("at", "entity")).dropDuplicates(["key", "at"])
    found = found.withColumn("kind", kind_of(F.col("entity"))).withColumn("canon", canonical(F.col("kind"), F.col("entity")))
    found = written(found.where(f"kind <> 'card' OR {luhn_sum('canon')} % 10 = 0"), "mentions")
    made = distinct_replacements(found.select("kind", "canon"), key)
    mentions = found.join(made, ["kind", "canon"]).select("key", "at", poured(F.col("kind"), F.col("entity"), F.col("made")).alias("new"))
    per_row = mentions.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("at", "new"))).alias("made"))
    joined = candidates.join(per_row, "key", "left")
    parts = F.split("body", PATTERN, -1)
    told = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda p, i: F.concat(F.coalesce(F.try_element_at("made", i), F.get(old, i)), p))
    whole = F.concat(F.get(parts, F.lit(0)), F.array_join(told, ""))

    def result(some: DataFrame, new: Column, n: Column) -> DataFrame:
        columns = [new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns if c != "n_entities"]
        return some.select(*columns, n.cast("bigint").alias("n_entities"))

    none = F.col("made").isNull()
    replaced = result(joined, F.when(none, F.col("body")).otherwise(whole), F.when(none, 0).otherwise(F.size("made")))
    return result(plain, F.col("body"), F.lit(0)).unionByName(replaced)
