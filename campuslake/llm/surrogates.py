"""PII surrogates: consistent keyed stand-ins for personal data, in DataFrame operations only.

Detected are e-mail addresses, phone numbers, IPv4 addresses, card numbers, secrets assigned to
names like ``token``, and person names behind a form of address. Every distinct entity, in its
canonical form (addresses lower-cased, numbers as digits only), gets one surrogate from a keyed
digest, wherever and however it is written, so mentions of one entity stay mentions of one.

Given and family names are entities of their own, so a person has the same stand-in by full and by
family name. In a document that names somebody behind a form of address, the family name is also
replaced where it stands without one, and the given name where the family name follows.

Surrogates keep type and format: digits stand for digits and separators stay, letters keep case
and script, octets keep their number of digits, e-mail domains map domain by domain and keep the
top level, given names keep gender (told by the form of address) and names their script.

Distinctness: surrogates are checked against each other and against all entities found; the
smallest canonical form keeps a contested surrogate and the others draw again, until none is
contested. After ``NARROW`` draws local parts, domains and octets may grow, after ``WIDE`` draws
numbers and secrets as well, so there are always new ones. E-mail domains are entities of their own,
distinct like all others.

Only documents with entities are joined; all others pass by.

Defined results: a null text stays null, an empty one empty; repeated rows get the same text. No
expression recurses or scans a text more than a bounded number of times, so texts of any length and
any make pass; an address has a local part of 64 characters and a domain of 32 labels at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Draws of the same length as the entity, for what may grow early and for the rest.
NARROW = 8
WIDE = 20

LETTER = r"\p{L}"
EMAIL = rf"[{LETTER}0-9][{LETTER}0-9._%+-]{{0,63}}@[{LETTER}0-9-]{{1,63}}(?:\.[{LETTER}0-9-]{{1,63}}){{0,30}}\.\p{{L}}{{2,63}}"
#: Names that secrets are assigned to, in any case.
SECRETS = "token|secret|api[_-]?key|access[_-]?key|private[_-]?key|password|passwd|pwd"
#: What is cheap comes first: few places follow a sign of assignment. Behind a colon a value has a digit.
SECRET = (
    r"""(?<=[=:][ \t"']{0,4})(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{8})(?:(?<==[ \t"']{0,4})|(?=[A-Za-z+/_-]{0,64}[0-9]))"""
    rf"""(?<=(?i:{SECRETS})["']?[ \t]{{0,3}}[=:][ \t]{{0,3}}["']?)[A-Za-z0-9+/_-]{{8,}}"""
)
IP = r"(?<![0-9.])(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}(?![0-9]|\.[0-9])"
#: With a country, with the area in parentheses, as three groups, and with a trunk zero.
PHONE = "|".join(
    (
        r"(?<![0-9])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])",
        r"(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])",
        r"(?<![0-9.,+-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
        r"(?<![0-9.,+-])0[0-9]{2,4}[ /-][0-9]{6,8}(?![0-9-])",
    )
)
CARD = r"(?<![0-9.])(?:3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7})(?![0-9])"
#: Forms of address, as they tell gender or not.
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Mlle", "Sra", "Señora", "г-жа", "κα")
MALE = ("Mr", "Herr", "Monsieur", "Sr", "Señor", "г-н", "κ")
EITHER = ("Dr", "Prof", "Professor")
WORD = r"\p{Lu}\p{L}+(?:-\p{Lu}\p{L}+)?"


def _behind(forms: tuple[str, ...]) -> str:
    """Names behind a form of address; the look ahead comes first: it is cheap and fails at most places."""
    return rf"(?=\p{{Lu}})(?<=(?<!{LETTER})(?:{'|'.join(forms)})\.? ){WORD}(?: {WORD})?"


NAME = _behind((*FEMALE, *MALE, *EITHER))
#: A name that stands alone.
ALONE = rf"(?<!{LETTER}){WORD}(?!{LETTER})"
#: Types in the order in which they are tried.
TYPES = {"email": EMAIL, "secret": SECRET, "ip": IP, "phone": PHONE, "card": CARD}
ANY = "|".join([*TYPES.values(), NAME])

#: Given names by gender and syllables of family names, by script.
GIVEN = {
    ("latin", "f"): "Anna Clara Elena Emma Ida Julia Laura Lena Maria Nina Nora Olga Paula Rita Sara Vera".split(),
    ("latin", "m"): "Adam Anton Bruno David Emil Felix Hugo Ivan Jonas Karl Leo Marco Oscar Paul Peter Viktor".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Иван Лев Олег Павел Пётр".split(),
    ("greek", "f"): "Άννα Ελένη Ειρήνη Ζωή Κλειώ Μαρία Νίκη Σοφία".split(),
    ("greek", "m"): "Ανδρέας Γιώργος Ηλίας Λεωνίδας Νίκος Πέτρος Σπύρος Φώτης".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va".split(),
    "cyrillic": "ба бе бо да де до ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те то ва ве во за зо".split(),
    "greek": "βα βο δα δο κα κο λα λο μα μο να νο πα πο ρα ρο".split(),
}
#: Letters of each script that stand for one another, by case.
ALPHABETS = (
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåæçèéêëìíîïñòóôõöøùúûüýß",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω",
    "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    "0123456789",
)
#: Stand-ins for letters outside these alphabets, by script; the first that fits is drawn from.
OTHERS = {
    r"\p{IsHan}": "天地人山水火木金土日月星風雨雲花草林石川海田村城門道光明文心",
    r"\p{IsHiragana}": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほ",
    r"\p{IsKatakana}": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホ",
    r"\p{IsHangul}": "가나다라마바사아자차카타파하고노도로모보소오조초코토포호",
    r"\p{IsArabic}": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת",
    r"\p{IsDevanagari}": "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह",
    r"(?=\p{IsCyrillic})\p{Lu}": ALPHABETS[5],
    r"\p{IsCyrillic}": ALPHABETS[4],
    r"(?=\p{IsGreek})\p{Lu}": ALPHABETS[7],
    r"\p{IsGreek}": ALPHABETS[6],
    r"\p{Lu}": ALPHABETS[1],
    r"\p{L}": ALPHABETS[0],
}


def detected(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def _number(digest: Column, at: Column | int) -> Column:
    """A number below 2**28 from seven hex digits of a digest that is repeated as needed."""
    start = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.substring(digest, (start * 7) % 57 + 1, F.lit(7)), 16, 10).cast("long")


def _redrawn(word: Column, seed: Column, alphabets: tuple[str, ...] = ALPHABETS) -> Column:
    """``word`` with every letter and digit replaced by one of its own script and case."""

    def letter(c: Column, i: Column) -> Column:
        # Every eight characters a new digest.
        number = _number(F.sha2(F.concat_ws("|", seed, (i / 8).cast("int")), 256), i % 8)
        pick = lambda alphabet: F.substring(F.lit(alphabet), (number % len(alphabet) + 1).cast("int"), F.lit(1))
        choice = c
        for pattern, alphabet in reversed(OTHERS.items()):
            choice = F.when(c.rlike(pattern), pick(alphabet)).otherwise(choice)
        for alphabet in alphabets:
            choice = F.when(F.contains(F.lit(alphabet), c), pick(alphabet)).otherwise(choice)
        return choice

    return F.array_join(F.transform(F.split(word, ""), letter), "")


def _octet(octet: Column, i: Column, seed: Column, draw: Column) -> Column:
    number = _number(F.sha2(seed, 256), i)
    return (
        F.when((F.length(octet) == 1) & (draw < NARROW), number % 9 + 1)
        .when((F.length(octet) == 2) & (draw < NARROW), number % 90 + 10)
        .when(draw < WIDE, number % 155 + 100)
        .otherwise(number % 900 + 100)
        .cast("string")
    )


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _family(syllables: list[str], digest: Column, length: Column) -> Column:
    parts = F.transform(F.sequence(F.lit(1), length), lambda i: _pick(syllables, _number(digest, i)))
    return F.initcap(F.array_join(parts, ""))


def _name(type_: Column, canonical: Column, seed: Column, draw: Column) -> Column:
    """A given or family name; each further draw makes it a syllable longer, so there are always new ones."""
    digest, script = F.sha2(seed, 256), _script(canonical)
    out = F.lit(None).cast("string")
    for kind, syllables in SYLLABLES.items():
        female, male = GIVEN[kind, "f"], GIVEN[kind, "m"]
        first = _number(digest, 0)
        given = F.when(type_ == "given_f", _pick(female, first)).when(type_ == "given_m", _pick(male, first))
        more = F.when(draw > 0, F.lower(_family(syllables, digest, draw))).otherwise("")
        named = F.concat(given.otherwise(_pick([*female, *male], first)), more)
        out = F.when(script == kind, F.when(type_ == "family", _family(syllables, digest, draw + 3)).otherwise(named)).otherwise(out)
    return out


def drawn(type_: Column, canonical: Column, seed: Column, draw: Column, place: Column) -> Column:
    """The surrogate of a canonical entity at a draw; ``place`` is the surrogate of an address's domain.

    ``seed`` is a digest of key, type, entity and draw.
    """
    # The longer it takes to find a free one, the more letters stand for the ones there are.
    longer = F.repeat(F.lit("a"), F.greatest(draw - NARROW + 1, F.lit(0)))
    local = F.concat(F.regexp_extract(canonical, "^(.*)@", 1), longer)
    domain = F.concat(F.regexp_extract(canonical, r"^(.*)\.[^.]*$", 1), longer)
    top = F.regexp_extract(canonical, r"\.[^.]*$", 0)
    wide = F.greatest(draw - WIDE + 1, F.lit(0))
    number = F.concat(canonical, F.repeat(F.lit("0"), wide))
    octets = F.array_join(F.transform(F.split(canonical, r"\."), lambda o, i: _octet(o, i, seed, draw)), ".")
    return (
        F.when(type_ == "email", F.concat(_redrawn(local, seed), F.lit("@"), place))
        .when(type_ == "domain", F.concat(_redrawn(domain, seed), top))
        .when(type_ == "ip", octets)
        .when((type_ == "family") | type_.startswith("given"), _name(type_, canonical, seed, draw))
        .when(canonical.rlike("^[0-9a-f]+$") & (type_ == "secret"), _redrawn(number, seed, ("abcdef", "0123456789")))
        .otherwise(_redrawn(number, seed))
    )


def poured(entity: Column, type_: Column, surrogate: Column) -> Column:
    """The surrogate in the written form of the entity: its digits in the places of the entity's."""
    chars = F.split(entity, "")
    upto = lambda i: F.length(F.regexp_replace(F.substring(entity, F.lit(1), i + 1), "[^0-9]", ""))
    digits = F.transform(
        chars, lambda c, i: F.when(c.rlike("[0-9]"), F.substring(surrogate, upto(i), F.lit(1))).otherwise(c)
    )
    # Where numbers had to grow, the rest follows at the end.
    rest = F.substring(surrogate, F.length(F.regexp_replace(entity, "[^0-9]", "")) + 1, F.length(surrogate))
    return F.when(type_.isin("phone", "card"), F.concat(F.array_join(digits, ""), rest)).otherwise(surrogate)


def _typed(found: DataFrame) -> DataFrame:
    """(rid, before, entity, i, type, canonical) from (rid, before, entity): names have a row for each word."""
    whole = {name: F.col("entity").rlike(f"^(?:{pattern})$") for name, pattern in TYPES.items() if name != "secret"}
    context = F.concat(F.col("before"), F.col("entity"))
    named = F.lit("secret")
    for kind, forms in (("given_u", EITHER), ("given_m", MALE), ("given_f", FEMALE)):
        named = F.when(context.rlike(f"(?:{_behind(forms)})$"), kind).otherwise(named)
    kind = reduce(lambda rest, name: F.when(whole[name], name).otherwise(rest), ["card", "phone", "ip", "email"], named)
    typed = found.withColumn("kind", kind)
    canonical = (
        F.when(F.col("kind").isin("phone", "card"), F.regexp_replace("entity", "[^0-9]", ""))
        .when(F.col("kind") == "email", F.lower("entity"))
        .otherwise(F.col("entity"))
    )
    words = F.split("entity", " ")
    family = lambda word: F.struct(F.lit("family").alias("type"), word.alias("canonical"))
    given = F.struct(F.col("kind").alias("type"), F.get(words, F.lit(0)).alias("canonical"))
    person = F.when(F.size(words) > 1, F.array(given, family(F.get(words, F.lit(1))))).otherwise(F.array(family(F.get(words, F.lit(0)))))
    plain = F.array(F.struct(F.col("kind").alias("type"), canonical.alias("canonical")))
    parts = F.when(F.col("kind").startswith("given"), person).otherwise(plain)
    return typed.select("rid", "before", "entity", F.posexplode(parts).alias("i", "part")).select(
        "rid", "before", "entity", "i", "part.type", "part.canonical"
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(type, canonical, surrogate) for distinct (type, canonical), all surrogates different from each other and from all entities."""
    at = F.when(F.col("type") == "email", F.regexp_extract("canonical", "@(.*)$", 1))
    held = entities.withColumn("at", at)
    found = held.where(F.col("at").isNotNull()).select(F.lit("domain").alias("type"), F.col("at").alias("canonical")).distinct()
    places = _settled(found.withColumn("place", F.lit(None).cast("string")), key)
    places = places.select(F.col("canonical").alias("at"), F.col("surrogate").alias("place"))
    # Most entities of a domain may be those of one: only its distinct addresses meet here.
    return _settled(materialize(held.join(places, "at", "left").select("type", "canonical", "place"), "placed"), key)


def _settled(entities: DataFrame, key: str) -> DataFrame:
    """``assign`` for (type, canonical, place)."""
    known = entities.select("type", F.col("canonical").alias("surrogate"))
    settled = None
    open_ = entities.withColumn("draw", F.lit(0))
    while True:
        # Digested once, not again for every letter of a long entity.
        seed = F.sha2(F.concat_ws("|", F.lit(key), "type", "canonical", F.col("draw").cast("string")), 256)
        seeded = materialize(open_.withColumn("seed", seed), "seeded")
        surrogate = drawn(F.col("type"), F.col("canonical"), F.col("seed"), F.col("draw"), F.col("place"))
        tried = materialize(seeded.withColumn("surrogate", surrogate).drop("seed"), "drawn")
        taken = known if settled is None else known.unionByName(settled.select("type", "surrogate"))
        first = tried.groupBy("type", "surrogate").agg(F.min("canonical").alias("winner"))
        free = first.join(taken.distinct(), ["type", "surrogate"], "left_anti")
        judged = tried.join(free, ["type", "surrogate"], "left")
        won = F.coalesce(F.col("winner") == F.col("canonical"), F.lit(False))
        fresh = judged.where(won).select("type", "canonical", "surrogate")
        settled = materialize(fresh if settled is None else settled.unionByName(fresh), "settled")
        open_ = judged.where(~won).select("type", "canonical", "place", (F.col("draw") + 1).alias("draw"))
        if not open_.limit(1).count():
            return settled


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Documents as (row, n_entities): ``row`` holds all columns with the new text."""
    body = F.col(f"row.`{text}`")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    clean = packed.where(body.isNull() | ~body.rlike(ANY))
    dirty = materialize(
        packed.where(body.rlike(ANY)).withColumn("rid", F.xxhash64(body)).withColumn("found", detected(body)).withColumn(
            "rest", F.split(body, ANY, -1)
        ),
        "entity-documents",
    )
    each = dirty.select("rid", "rest", F.posexplode("found").alias("i", "entity")).select(
        "rid", "entity", F.substring(F.get("rest", F.col("i")), -16, 16).alias("before")
    )
    mentions = materialize(_typed(each.distinct()), "mentions")
    surrogates = assign(mentions.select("type", "canonical").distinct(), key)
    given = materialize(
        mentions.join(surrogates, ["type", "canonical"]).select(
            "rid", "entity", "before", "i", "type", "canonical",
            poured(F.col("entity"), F.col("type"), F.col("surrogate")).alias("put"),
        ),
        "given",
    )
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "put"))), lambda w: w["put"]), " ")
    puts = given.groupBy("rid", "entity", "before").agg(words.alias("put"))
    maps = puts.groupBy("rid").agg(
        F.map_from_entries(F.collect_list(F.struct(F.struct("entity", "before").alias("mention"), "put"))).alias("puts")
    )
    joined = dirty.join(maps, "rid").join(_persons(given), "rid", "left")
    # What stands between entities, with the names of persons who are mentioned elsewhere.
    named = F.col("families").isNotNull()
    between = F.when(named, F.transform("rest", lambda r: _renamed(r)["text"])).otherwise(F.col("rest"))
    further = F.when(named, F.aggregate("rest", F.lit(0), lambda n, r: n + _renamed(r)["n"])).otherwise(0)
    piece = F.zip_with(
        between,
        F.transform(
            "rest",
            lambda rest, i: F.try_element_at(
                F.col("puts"), F.struct(F.get("found", i).alias("entity"), F.substring(rest, -16, 16).alias("before"))
            ),
        ),
        lambda rest, put: F.concat(rest, F.coalesce(put, F.lit(""))),
    )
    changed = joined.select(
        F.col("row").withField(f"`{text}`", F.array_join(piece, "")).alias("row"),
        (F.size("found") + further).cast("long").alias("n_entities"),
    )
    return changed.unionByName(clean.withColumn("n_entities", F.lit(0).cast("long")))


def _persons(given: DataFrame) -> DataFrame:
    """(rid, families, givens): the stand-ins of the names that a document has, by name."""
    names = given.where((F.col("type") == "family") | F.col("type").startswith("given"))
    each = names.groupBy("rid", (F.col("type") == "family").alias("family"), "canonical").agg(F.min("put").alias("put"))

    def of(family: bool) -> Column:
        pairs = F.collect_list(F.when(F.col("family") == family, F.struct("canonical", "put")))
        return F.map_from_entries(pairs)

    return each.groupBy("rid").agg(of(True).alias("families"), of(False).alias("givens"))


def _renamed(text: Column) -> Column:
    """(text, n): family names of the document's persons replaced, and given names before them."""
    words, between = F.regexp_extract_all(text, F.lit(ALONE), F.lit(0)), F.split(text, ALONE, -1)

    def new(i: Column) -> Column:
        follows = (F.get(between, i + 1) == " ") & F.map_contains_key(F.col("families"), F.coalesce(F.get(words, i + 1), F.lit("")))
        word = F.coalesce(F.get(words, i), F.lit(""))
        return F.coalesce(F.try_element_at(F.col("families"), word), F.when(follows, F.try_element_at(F.col("givens"), word)))

    parts = F.transform(between, lambda b, i: F.concat(b, F.coalesce(new(i), F.get(words, i), F.lit(""))))
    count = F.aggregate(F.sequence(F.lit(0), F.size(words)), F.lit(0), lambda n, i: n + F.when(new(i).isNotNull(), 1).otherwise(0))
    return F.struct(F.array_join(parts, "").alias("text"), count.alias("n"))
