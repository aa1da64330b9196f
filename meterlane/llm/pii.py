"""Personal data replaced by keyed surrogates of the same type, script and format. Native.

Entities are found by patterns. Two mentions of one entity (an address in another case, a
number with other separators) have one canonical form and get one surrogate, laid into the
format of each mention. Surrogates come from a keyed digest. All distinct entities are
checked together: no two of a type share a surrogate and no surrogate is an entity of the
corpus; who loses a tie draws again. Where most values of a shape are taken, so that drawing
doesn't end, the entities of that shape are permuted among themselves in a keyed order:
each gets the next one's form, so surrogates stay distinct and none stands for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlane.operators import ordered
from meterlane.session import materialize, slice_count

KEY = "surrogates-1"
# Draws of an entity before its shape counts as full.
DRAWS = 8

# Titles before a name by gender.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Госпожа")
# Given names by script and gender.
GIVEN = {
    ("latin", "m"): ("Adrian", "Bruno", "Carlos", "Daniel", "Emil", "Felix", "Gabriel", "Hugo", "Ivan", "Jonas", "Karl", "Leon"),
    ("latin", "f"): ("Anna", "Bianca", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irene", "Julia", "Karla", "Laura"),
    ("cyrillic", "m"): ("Андрей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Максим", "Олег", "Павел", "Роман"),
    ("greek", "m"): ("Αλέξης", "Βασίλης", "Γιάννης", "Δημήτρης", "Ηλίας", "Κώστας", "Λεωνίδας", "Μάριος", "Νίκος", "Πέτρος", "Σταύρος", "Φώτης"),
    ("greek", "f"): ("Αγγελική", "Βασιλική", "Γεωργία", "Δέσποινα", "Ελένη", "Ζωή", "Ιωάννα", "Κατερίνα", "Μαρία", "Νίκη", "Σοφία", "Χριστίνα"),
    ("cyrillic", "f"): ("Алина", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Ирина", "Ксения", "Лариса", "Марина", "Нина", "Ольга"),
}
# Syllables of invented family names.
SYLLABLES = {
    "latin": ("ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu", "na", "pe", "ri", "so", "tu", "va", "we", "zi", "bro", "stel"),
    "greek": ("βα", "γε", "δι", "ζο", "θυ", "κα", "λε", "μι", "νο", "ξυ", "πα", "ρε", "σι", "το", "φυ", "χα", "ψε", "βρι", "στα", "κλο"),
    "cyrillic": ("ба", "ве", "ги", "до", "жу", "за", "ке", "ли", "мо", "ну", "па", "ре", "си", "то", "фу", "ха", "це", "чи", "бро", "сте"),
}

MALE_TITLES, FEMALE_TITLES = (tuple(dict.fromkeys((*t, *(w.upper() for w in t)))) for t in (MALE_TITLES, FEMALE_TITLES))
_TITLE = "|".join(sorted((*MALE_TITLES, *FEMALE_TITLES), key=len, reverse=True))
# Hyphens, apostrophes and capitals inside belong to a name.
_WORD = r"\p{Lu}(?:[\p{L}\p{M}]|['’-](?=\p{L}))++"
PATTERNS = {
    "email": r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++@[\p{L}0-9-]++(?:\.[\p{L}0-9-]++)*\.\p{L}{2,}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,48})(?![0-9A-Za-z])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])",
    "account": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])",
    "national": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "name": rf"(?<![\p{{L}}0-9])(?:{_TITLE})\.? {_WORD}(?: (?:[dl]['’])?{_WORD})?",
}
ENTITY = "|".join(PATTERNS.values())
LATIN, LATIN_UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GREEK, GREEK_UPPER = "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"
CYRILLIC, CYRILLIC_UPPER = "абвгдежзиклмнопрстуфхцчшэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"


def replace_entities(docs: DataFrame, key: str = KEY, text_column: str = "text",
                     count_column: str | None = None) -> DataFrame:
    """``docs`` with every entity in the text replaced; ``count_column`` adds how many.

    All rows and columns stay. Texts without entities, null and empty ones are untouched;
    rows that repeat get the same replacements. An empty table stays empty. ``key`` is the caller's:
    who knows it can redo the draws, so keep it secret and use one of your own; the default is for tests.
    """
    taken = set(docs.columns)
    own = lambda name: next(n for k in range(len(taken) + 1) if (n := f"{name}_{k}") not in taken)
    ents, link, new = own("entities"), own("mentions"), own("surrogates")
    text = F.col(f"`{text_column}`")
    has = F.coalesce(text.rlike(r"[0-9@]|" + _TITLE) & text.rlike(ENTITY), F.lit(False))
    found = docs.filter(has).withColumn(ents, F.regexp_extract_all(text, F.lit(f"({ENTITY})"), F.lit(0)))
    found = found.withColumn(link, F.sha2(F.array_join(ents, "\n"), 256))
    lists = materialize(found.select(F.col(ents).alias("entities"), F.col(link).alias("mentions"))
                        .dropDuplicates(["mentions"]), "mentions")
    made = _replacements(lists, key).withColumnsRenamed({"mentions": link, "surrogates": new})
    pieces = F.split(text, ENTITY, -1)
    rebuilt = F.array_join(F.zip_with(pieces, F.col(new), lambda p, s: F.concat(p, F.coalesce(s, F.lit("")))), "")
    columns = [rebuilt.alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns]
    plain = [F.col(f"`{c}`") for c in docs.columns]
    if count_column:
        columns.append(F.size(ents).cast("long").alias(count_column))
        plain.append(F.lit(0).cast("long").alias(count_column))
    return found.join(made, link).select(*columns).unionAll(docs.filter(~has).select(*plain))


def _replacements(lists: DataFrame, key: str) -> DataFrame:
    """(mentions, surrogates): the surrogates of each distinct list of entities, in its order."""
    mentions = lists.select("mentions", F.posexplode("entities").alias("pos", "entity"))
    typed = mentions.withColumn("type", kind_of(F.col("entity"))).withColumn("canon", canonical(F.col("entity"), F.col("type")))
    digests = entity_digests(typed.select("type", "canon").distinct(), key)
    laid = typed.join(digests, ["type", "canon"]).repartition(slice_count(lists.sparkSession), "mentions").withColumn(
        "surrogate", F.when(F.col("target").isNull(), rendered(F.col("entity"), F.col("type"), F.col("digest"))).otherwise(
            laid_out(F.col("entity"), F.col("type"), F.col("target"))))
    return laid.groupBy("mentions").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "surrogate"))), lambda x: x["surrogate"]).alias("surrogates"))


def entity_digests(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(type, canon, digest, target): digests whose surrogates are distinct and no entities
    themselves, or for entities of a full shape the form of another one of them.

    Only entities that collide are drawn again, so turns get short at once; with n entities
    and s possible surrogates a turn leaves about n / s of them, and there are ``DRAWS`` turns.
    """
    # Few bytes, but much to compute: a set number of partitions, which are not merged.
    slices = slice_count(entities.sparkSession)
    tries = entities.withColumn("attempt", F.lit(0))
    for turn in range(DRAWS):
        drawn = tries.repartition(slices, F.xxhash64("type", "canon")).withColumn("digest", F.sha2(F.concat_ws("\x00", F.lit(key), "type", "canon", F.col("attempt").cast("string")), 256))
        # Step by step, so that no expression holds copies of another.
        drawn = drawn.withColumn("mention", _plain(F.col("canon"), F.col("type")))
        drawn = drawn.withColumn("made", rendered(F.col("mention"), F.col("type"), F.col("digest")))
        drawn = materialize(drawn.withColumn("form", canonical(F.col("made"), F.col("type"))).drop("mention", "made"), "surrogates")
        # The smallest entity of a form keeps it, unless the form is an entity itself.
        owner = drawn.groupBy("type", "form").agg(F.min("canon").alias("owner"), F.count("*").alias("n"))
        clash = (owner.join(drawn.select("type", F.col("canon").alias("form"), F.lit(True).alias("real")), ["type", "form"], "left")
                 .filter((F.col("n") > 1) | F.col("real")).select("type", "form", "owner", "real"))
        if clash.isEmpty():
            return drawn.select("type", "canon", "digest", F.lit(None).cast("string").alias("target"))
        lost = F.coalesce(F.col("real") | (F.col("owner") != F.col("canon")), F.lit(False))
        tries = drawn.join(clash, ["type", "form"], "left").select("type", "canon", "digest", (F.col("attempt") + lost.cast("int")).alias("attempt"), lost.alias("lost"))
        if turn < DRAWS - 1:
            tries = tries.select("type", "canon", "attempt")
    return _permuted(materialize(tries, "full-shapes"), key)


def _permuted(drawn: DataFrame, key: str) -> DataFrame:
    """Rows (type, canon, digest, lost) with the next entity of their shape as ``target`` where the
    shape has one that found no surrogate. A shape's entities are ordered in slices, so it may be large."""
    shaped = drawn.withColumn("shape", _shape(F.col("canon"), F.col("type")))
    full = shaped.filter("lost").select("type", "shape").distinct()
    inside = shaped.join(full, ["type", "shape"]).withColumn("draw", F.sha2(F.concat_ws("\x00", F.lit(key), "canon"), 256))
    first = inside.groupBy("type", "shape").agg(F.min_by("canon", F.struct("draw", "canon")).alias("first"))
    following = ordered.framed(inside, ["type", "shape"], [F.col("draw"), F.col("canon")], {"next": lambda w: F.lead("canon").over(w)}, after=1)
    turned = following.join(first, ["type", "shape"]).select("type", "canon", "digest", F.coalesce("next", "first").alias("target"))
    return shaped.join(full, ["type", "shape"], "left_anti").select(
        "type", "canon", "digest", F.lit(None).cast("string").alias("target")).unionByName(turned)


def _shape(canon: Column, kind: Column) -> Column:
    """What a form keeps of an entity when another one's signs are laid into it."""
    words = F.when(canon.rlike(r"\p{IsCyrillic}"), "c").otherwise(F.when(canon.rlike(r"\p{IsGreek}"), "g").otherwise("l"))
    name = F.concat_ws(" ", F.substring(canon, 1, 1), words, F.size(F.split(canon, " ")).cast("string"))
    signs = F.regexp_replace(F.regexp_replace(F.regexp_replace(canon, "[0-9]", "0"), r"\p{Lu}", "A"), r"\p{Ll}", "a")
    return F.when(kind == "name", name).when(kind == "ip", "ip").otherwise(signs)


def laid_out(entity: Column, kind: Column, target: Column) -> Column:
    """Another entity's canonical form in the format and case of this mention."""
    title, name = _parts(entity)
    signs = F.regexp_replace(target, r"[^\p{L}0-9]", "")

    def sign(c: Column, at: Column) -> Column:
        place = F.length(F.regexp_replace(F.substring(entity, F.lit(1), at + 1), r"[^\p{L}0-9]", ""))
        new = F.substring(signs, place, F.lit(1))
        return F.when(~c.rlike(r"[\p{L}0-9]"), c).when(c.rlike(r"\p{Lu}"), F.upper(new)).otherwise(F.when(c.rlike(r"\p{Ll}"), F.lower(new)).otherwise(new))

    family = F.substring(target, F.lit(3), F.length(target))
    shown = F.when(name == F.upper(name), F.upper(family)).otherwise(F.initcap(family))
    return (F.when(kind == "name", F.concat(title, shown)).when(kind.isin("ip", "secret"), target)
            .otherwise(F.array_join(F.transform(_signs(entity), sign), "")))


def kind_of(entity: Column) -> Column:
    """The first type whose pattern the entity fills."""
    out = F.lit("name")
    for name, pattern in reversed([p for p in PATTERNS.items() if p[0] != "name"]):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), name).otherwise(out)
    return out


def _parts(entity: Column) -> tuple[Column, Column]:
    """Title with the blank after it, and the name."""
    title = F.regexp_extract(entity, rf"^((?:{_TITLE})\.? )", 1)
    return title, F.substring(entity, F.length(title) + 1, F.length(entity))


def _gender(title: Column) -> Column:
    return F.when(F.regexp_replace(title, r"[. ]", "").isin(*MALE_TITLES), "m").otherwise("f")


def canonical(entity: Column, kind: Column) -> Column:
    """Case and separators do not tell entities apart; for names the gender does."""
    title, name = _parts(entity)
    return (F.when(kind == "name", F.concat(_gender(title), F.lit(" "), F.lower(name)))
            .when(kind.isin("email", "ip"), F.lower(entity))
            .when(kind == "secret", entity)
            .otherwise(F.regexp_replace(F.upper(entity), r"[^0-9A-Z]", "")))


def _plain(canon: Column, kind: Column) -> Column:
    """A mention that has this canonical form, to see which one its surrogate has."""
    name = F.initcap(F.substring(canon, F.lit(3), F.length(canon)))
    cyrillic = name.rlike(r"\p{IsCyrillic}")
    title = F.when(F.substring(canon, 1, 1) == "m", F.when(cyrillic, "Г-н ").otherwise("Mr ")).otherwise(
        F.when(cyrillic, "Г-жа ").otherwise("Mrs "))
    return F.when(kind == "name", F.concat(title, name)).otherwise(canon)


def _draw(digest: Column, place: Column, choices: int) -> Column:
    return F.pmod(F.xxhash64(digest, place), F.lit(choices)).cast("int")


def _pick(values: str | tuple[str, ...], digest: Column, place: Column) -> Column:
    if isinstance(values, str):
        return F.substring(F.lit(values), _draw(digest, place, len(values)) + 1, F.lit(1))
    return F.element_at(F.array(*[F.lit(v) for v in values]), _draw(digest, place, len(values)) + 1)


def rendered(entity: Column, kind: Column, digest: Column) -> Column:
    """The surrogate in the format of this mention."""
    octet = lambda k, low, count: (_draw(digest, F.lit(k), count) + low).cast("string")
    address = F.concat_ws(".", octet(0, 1, 223), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 254))
    ending = F.regexp_extract(entity, r"(\.\p{L}+)$", 1)
    mail = F.concat(_by_sign(F.substring(entity, F.lit(1), F.length(entity) - F.length(ending)), digest), ending)
    country = F.regexp_extract(entity, r"^(\+[0-9]{1,3}(?=[ .(-]))", 1)
    called = F.concat(country, _by_sign(F.substring(entity, F.length(country) + 1, F.length(entity)), digest))
    hexes = F.array_join(F.transform(F.sequence(F.lit(1), F.length(entity)),
                                     lambda k: _pick("0123456789abcdef", digest, k.cast("int"))), "")
    prefix = F.regexp_extract(entity, r"^(AKIA|gh[pousr]_|sk-)", 1)
    token = F.concat(prefix, _by_sign(F.substring(entity, F.length(prefix) + 1, F.length(entity)), digest))
    return (F.when(kind == "email", mail).when(kind == "ip", address).when(kind == "phone", called)
            .when(kind == "card", _card(entity, digest)).when(kind == "name", _name(entity, digest))
            .when(kind == "account", F.concat(F.substring(entity, 1, 2), _by_sign(F.substring(entity, F.lit(3), F.length(entity)), digest)))
            .when((kind == "secret") & entity.rlike("^[0-9a-f]+$"), hexes).when(kind == "secret", token)
            .otherwise(_by_sign(entity, digest)))


def _signs(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _by_sign(text: Column, digest: Column) -> Column:
    """Digits become digits, letters letters of their script and case; other signs stay.

    The n-th letter or digit is drawn by n, so separators don't change what is drawn."""
    def sign(c: Column, at: Column) -> Column:
        place = F.length(F.regexp_replace(F.substring(text, F.lit(1), at + 1), r"[^\p{L}0-9]", ""))
        pick = lambda letters: _pick(letters, digest, place)
        upper = c.rlike(r"\p{Lu}")
        return (F.when(c.rlike("[0-9]"), pick("0123456789"))
                .when(c.rlike(r"\p{IsCyrillic}"), F.when(upper, pick(CYRILLIC_UPPER)).otherwise(pick(CYRILLIC)))
                .when(c.rlike(r"\p{IsGreek}"), F.when(upper, pick(GREEK_UPPER)).otherwise(pick(GREEK)))
                .when(c.rlike(r"\p{L}"), F.when(upper, pick(LATIN_UPPER)).otherwise(pick(LATIN))).otherwise(c))

    return F.array_join(F.transform(_signs(text), sign), "")


def _luhn(digits: Column) -> Column:
    """Sum whose remainder by ten is 0 for valid card numbers; ``digits`` is an array of ints."""
    size = F.size(digits)
    doubled = F.transform(digits, lambda d, k: F.when((size - k) % 2 == 0, F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d)


def _card(entity: Column, digest: Column) -> Column:
    """The first digit stays, the others are drawn; a valid check digit stays valid."""
    own = F.transform(_signs(F.regexp_replace(entity, "[^0-9]", "")), lambda c: c.cast("int"))
    drawn = F.concat(F.slice(own, 1, 1), F.transform(F.sequence(F.lit(2), F.size(own)), lambda k: _draw(digest, k.cast("int"), 10)))
    valid = _luhn(own) % 10 == 0
    head = F.slice(drawn, F.lit(1), F.size(own) - 1)
    check = F.pmod(-_luhn(F.concat(head, F.array(F.lit(0)))), F.lit(10)).cast("int")
    digits = F.when(valid, F.concat(head, F.array(check))).otherwise(drawn)
    place = lambda at: F.length(F.regexp_replace(F.substring(entity, F.lit(1), at), "[^0-9]", ""))
    return F.array_join(F.transform(_signs(entity), lambda c, k: F.when(
        c.rlike("[0-9]"), F.element_at(digits, place(k + 1)).cast("string")).otherwise(c)), "")


def _name(entity: Column, digest: Column) -> Column:
    """Title, given name of the title's gender if there was one, and an invented family name."""
    title, name = _parts(entity)

    def made(script: str) -> Column:
        family = F.initcap(F.concat(*[_pick(SYLLABLES[script], digest, F.lit(k)) for k in range(1, 5)]))
        given = F.when(_gender(title) == "m", _pick(GIVEN[script, "m"], digest, F.lit(0))).otherwise(
            _pick(GIVEN[script, "f"], digest, F.lit(0)))
        return F.when(name.contains(" "), F.concat(given, F.lit(" "), family)).otherwise(family)

    new = (F.when(name.rlike(r"\p{IsCyrillic}"), made("cyrillic")).when(name.rlike(r"\p{IsGreek}"), made("greek"))
           .otherwise(made("latin")))
    return F.concat(title, F.when(name == F.upper(name), F.upper(new)).otherwise(new))
