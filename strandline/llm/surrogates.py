"""PII surrogate generation. DataFrame and SQL functions only.

Entities are found by one alternation of patterns. Each distinct entity (kind, normal form) gets a
surrogate from a keyed SHA-512 of both: the same kind, script, letter case, separators and length, the
same country code of a telephone number, given names of the same gender, card and bank account numbers
that pass their check if the original does. The normal form ignores what does not identify (case of
addresses, separators of numbers), so mentions of one entity get one surrogate. Persons are found by a
title; all their names are replaced, and so is every later or earlier mention of one of these names in
the same document without a title. Collision checks run over the dictionary of all distinct entities:
where two share a surrogate, or a surrogate is an entity of the corpus, all but the least take their
next attempt, until none is left; every WIDEN attempts the surrogates of those get longer (an address
of the Internet protocol: any octets or groups), so that a format whose values are all taken is no dead end.
Replacements reach the texts by a join on the document; texts without entities are not shuffled.

Not found: persons that a document never gives a title, postal addresses, dates of birth, telephone
numbers of fewer than ten digits without a country code.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialise

#: Attempts after which surrogates get longer by one character.
WIDEN = 4

# What the patterns look for.
TITLES_MALE = ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Господин")
TITLES_FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Doña", "Госпожа")
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
NAME = r"\p{Lu}[\p{L}'’\-]*+"
#: Country codes of telephone numbers: those of one and two digits; all others have three.
COUNTRY_CODE = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: kind -> pattern, first match wins where several begin.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)",
    "ipv6": r"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "secret": r"(?<![A-Za-z0-9_])(?=[A-Za-z_\-]*[0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9\-]{20,}|[A-Fa-f0-9]{32,128})(?![A-Za-z0-9_])",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?!\d|-\d)",
    "phone": r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\d)|(?<![\d.\-])\d{3}(?:\.\d{3}\.|-\d{3}-| \d{3}[ \-])\d{4}(?!\d|[.\-]\d)",
    "card": r"(?<![\d.\-])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){2}[ \-]\d{1,7})(?!\d|-\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "person": rf"(?<!\p{{L}})(?:{'|'.join(TITLES_MALE + TITLES_FEMALE)})\.? {NAME}(?: {NAME}){{0,3}}",
}
#: The same, with a look at the next character before the alternatives that begin with it.
BY_FIRST = {"[0-9+(]": ("ip", "ipv6", "ssn", "phone", "card"), "[A-Za-z0-9._%+\\-]": ("email", "secret", "iban", "ipv6"), f"[{''.join(sorted({t[0] for t in TITLES_MALE + TITLES_FEMALE}))}]": ("person",)}
ANY = "|".join(f"(?={first})(?:{'|'.join(f'(?:{PATTERNS[k]})' for k in kinds)})" for first, kinds in BY_FIRST.items())


def may_hold(text: Column) -> Column:
    """False only where no pattern can match: every one needs a digit, an @ or a title."""
    out = text.rlike("[0-9@]")
    for title in TITLES_MALE + TITLES_FEMALE:
        if not any(title != t and title.startswith(t) for t in TITLES_MALE + TITLES_FEMALE):
            out = out | text.contains(title)
    return out


# Syllables of invented names, and how invented given names end, by script and gender.
SYLLABLES = {
    "latin": "ba be bo bu da de di do fa fe fi ga go ha he ka ke ki ko la le li lo lu ma me mi mo na ne ni no pa pe po ra re ri ro sa se si so ta te ti to va ve vi vo wa we wi za ze zi zo zu".split(),
    "cyrillic": "ба бе бо бу да де ди до фа фе га го ка ке ки ко ла ле ли ло лу ма ме ми мо на не ни но па пе по ра ре ри ро са се си со та те ти то ва ве ви во за зе зи зо".split(),
    "greek": "βα βε βο δα δε δι δο φα φε γα γο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο πα πε πο ρα ρε ρι ρο σα σε σι σο τα τε τι το ζα ζε ζι ζο".split(),
}
GIVEN_ENDS = {
    "latin": {"m": ["n", "rd", "s", "rt"], "f": ["na", "lia", "ra", "sia"]},
    "cyrillic": {"m": ["н", "р", "слав", "мир"], "f": ["на", "лия", "ра", "сия"]},
    "greek": {"m": ["ς", "νος", "ρος", "κος"], "f": ["να", "λια", "ρα", "σια"]},
}


def number(digest: Column, at: Column) -> Column:
    """Two hex digits of a SHA-512 as a number, by position; positions run round."""
    return F.conv(F.substr(digest, F.pmod(at, F.lit(63)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def pick(values: list[str], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.pmod(at, F.lit(len(values))) + 1)


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum of a string of digits whose last one is not doubled."""
    n = F.length(digits)
    values = F.transform(characters(digits), lambda c, i: F.when((n - 1 - i) % 2 == 0, c.cast("int")).when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def script_of(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def mod97(text: Column) -> Column:
    """The remainder of a bank account number whose letters count as 10 .. 35 (a lower-case string of letters and digits)."""
    step = lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 87) % 97)
    return F.aggregate(characters(text), F.lit(0), step)


def with_surrogate(tries: DataFrame, key: str) -> DataFrame:
    """tries (kind, norm, attempt) with s, the surrogate of the normal form, itself in normal form: the same length for all but names and late attempts."""
    kind, norm, digest = F.col("kind"), F.col("norm"), F.col("digest")
    extra = F.floor(F.col("attempt") / WIDEN).cast("int")
    further = lambda make: F.when(extra > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(extra, F.lit(1))), make), "")).otherwise("")
    two = lambda at: number(digest, at) * 256 + number(digest, at + 1)
    cs = characters(norm)
    mixed = lambda c, i, letters: F.when(c.rlike("[0-9]"), F.pmod(number(digest, i), F.lit(10)).cast("string")).when(c.rlike("[a-z]"), F.chr(97 + F.pmod(number(digest, i), F.lit(letters)))).otherwise(c)
    joined = lambda a: F.array_join(a, "")
    more_digits = further(lambda k: F.pmod(number(digest, 40 + k), F.lit(10)).cast("string"))
    more_letters = further(lambda k: F.chr(97 + F.pmod(number(digest, 40 + k), F.lit(26))))
    # Letters and digits are replaced in place; an address keeps its last label, a key its public prefix.
    keep_from = F.length(norm) - F.length(F.substring_index(norm, ".", -1))
    email = F.concat(more_letters, joined(F.transform(cs, lambda c, i: F.when(i >= keep_from, c).otherwise(mixed(c, i, 26)))))
    hexed = norm.rlike("^[0-9a-f]+$")
    prefix = F.length(F.regexp_extract(norm, "^(akia|asia|gh[pousr]_|sk-)", 1))
    secret = joined(F.transform(cs, lambda c, i: F.when(i < prefix, c).when(hexed, mixed(c, i, 6)).otherwise(mixed(c, i, 26))))
    octet = lambda o, i: F.when(extra > 0, F.pmod(two(2 * i), F.lit(256))).when(F.length(o) == 3, 100 + F.pmod(two(2 * i), F.lit(156))).when(F.length(o) == 2, 10 + F.pmod(number(digest, i), F.lit(90))).otherwise(F.pmod(number(digest, i), F.lit(10))).cast("string")
    ip = F.array_join(F.transform(F.split(norm, r"\."), octet), ".")
    ipv6 = F.when(extra > 0, F.regexp_replace(F.substring(digest, 1, 32), "(.{4})(?!$)", "$1:")).otherwise(joined(F.transform(cs, lambda c, i: mixed(c, i, 6))))
    code = F.when(norm.startswith("+"), F.length(F.substring_index(norm, "-", 1))).otherwise(0)
    digits = F.concat(joined(F.transform(cs, lambda c, i: F.when(i < code, c).otherwise(mixed(c, i, 26)))), more_digits)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    check = F.pmod(10 - F.pmod(luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    card = F.when(luhn_sum(norm) % 10 == 0, F.concat(body, check)).otherwise(digits)
    country = F.substring(norm, 1, 2)
    account = F.concat(joined(F.transform(F.slice(cs, 5, 100), lambda c, i: mixed(c, i, 26))), more_digits)
    sound = mod97(F.concat(F.substr(norm, F.lit(5)), F.substring(norm, 1, 4))) == 1
    wrong = F.lpad(F.pmod(two(60), F.lit(100)).cast("string"), 2, "0")
    iban = F.concat(country, F.when(sound, F.lpad((98 - mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0")).otherwise(wrong), account)
    name = F.lit(None).cast("string")
    syllable = lambda parts: lambda k: pick(parts, two(20 + 2 * k))
    for script, parts in SYLLABLES.items():
        stem = [*[pick(parts, two(F.lit(2 * k))) for k in range(4)], further(syllable(parts))]
        ends = GIVEN_ENDS[script]
        given = F.concat(*stem[:3], stem[4], F.when(kind == "given-f", pick(ends["f"], number(digest, F.lit(20)))).otherwise(pick(ends["m"], number(digest, F.lit(20)))))
        name = F.when(script_of(norm) == script, F.when(kind == "surname", F.concat(*stem)).otherwise(given)).otherwise(name)
    made = {"email": email, "secret": secret, "ip": ip, "ipv6": ipv6, "card": card, "iban": iban}
    s = digits
    for k, value in made.items():
        s = F.when(kind == k, value).otherwise(s)
    s = F.when(kind.isin("surname", "given-m", "given-f"), name).otherwise(s)
    hashed = F.sha2(F.concat_ws("|", F.lit(key), kind, norm, F.col("attempt").cast("string")), 512)
    return tries.withColumn("digest", hashed).withColumn("s", s).drop("digest")


def kind_of(match: Column) -> Column:
    out = F.lit("card")
    for kind in reversed(PATTERNS):
        out = F.when(match.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def person_words(match: Column) -> Column:
    return F.split(match, " ")


def normal_entities(match: Column, kind: Column) -> Column:
    """array<struct<kind, norm>> of a mention: one, or for persons one for each name (given names by gender)."""
    digits = F.regexp_replace(match, r"[^0-9]", "")
    # The country code is set apart, so that it stays.
    code = F.regexp_extract(digits, COUNTRY_CODE, 1)
    phone = F.when(match.startswith("+"), F.concat(F.lit("+"), code, F.lit("-"), F.substr(digits, F.length(code) + 1))).otherwise(digits)
    norm = F.when(kind.isin("email", "secret", "ipv6"), F.lower(match)).when(kind == "ip", match).when(kind == "phone", phone).when(kind == "iban", F.lower(F.regexp_replace(match, " ", ""))).otherwise(digits)
    words = person_words(match)
    female = F.regexp_replace(F.element_at(words, 1), r"\.", "").isin(*TITLES_FEMALE)
    names = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    of_person = F.transform(names, lambda w, i: F.struct(F.when(i == F.size(words) - 2, "surname").when(female, "given-f").otherwise("given-m").alias("kind"), F.lower(w).alias("norm")))
    return F.when(kind == "person", of_person).otherwise(F.array(F.struct(kind.alias("kind"), norm.alias("norm"))))


def cased(like: Column, word: Column) -> Column:
    return F.when((F.length(like) > 1) & (F.upper(like) == like), F.upper(word)).otherwise(F.concat(F.upper(F.substring(word, 1, 1)), F.substr(word, F.lit(2), F.length(word))))


def written(match: Column, kind: Column, chosen: Column) -> Column:
    """A mention with the surrogates of its entities, in the mention's own format."""
    first = F.element_at(chosen, 1)
    # Position by position, after what a late attempt put in front; case follows the mention.
    longer = F.greatest(F.length(first) - F.length(match), F.lit(0))
    body = F.zip_with(characters(match), characters(F.substr(first, longer + 1)), lambda c, n: F.when(c.rlike("[A-Z]"), F.upper(n)).otherwise(n))
    by_place = F.concat(F.substr(first, F.lit(1), longer), F.array_join(body, ""))
    # Numbers are short: the n-th letter or digit of the surrogate goes where the mention has its n-th; what is over, to the end.
    letters = F.regexp_replace(first, "[^0-9a-z]", "")
    rank = lambda i: F.length(F.regexp_replace(F.substr(match, F.lit(1), i + 1), "[^0-9A-Za-z]", ""))
    place = lambda c, i: F.when(~c.rlike("[0-9A-Za-z]"), c).when(c.rlike("[A-Z]"), F.upper(F.substr(letters, rank(i), F.lit(1)))).otherwise(F.substr(letters, rank(i), F.lit(1)))
    slots = F.length(F.regexp_replace(match, "[^0-9A-Za-z]", ""))
    by_rank = F.concat(F.array_join(F.transform(characters(match), place), ""), F.substr(letters, slots + 1))
    words = person_words(match)
    named = F.concat_ws(" ", F.element_at(words, 1), F.array_join(F.zip_with(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), chosen, cased), " "))
    capital = F.when((kind == "ipv6") & match.rlike("[A-F]"), F.upper(first)).otherwise(first)
    return F.when(kind.isin("ip", "ipv6"), capital).when(kind.isin("email", "secret"), by_place).when(kind == "person", named).otherwise(by_rank)


def distinct_surrogates(dictionary: DataFrame, key: str, rounds: int = 60) -> DataFrame:
    """(kind, norm, s): no two entities of a kind share s, and no s is an entity of the dictionary."""
    real = dictionary.select("kind", F.col("norm").alias("s"))
    shown = materialise(with_surrogate(dictionary.withColumn("attempt", F.lit(0)), key), "pii-tries")
    for _ in range(rounds):
        shared = shown.groupBy("kind", "s").agg(F.min("norm").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("kind", "s", "first")
        losers = shown.join(shared, ["kind", "s"]).where("norm <> first").select("kind", "norm")
        losers = materialise(losers.unionByName(shown.join(real, ["kind", "s"]).select("kind", "norm")).distinct(), "pii-losers")
        if losers.isEmpty():
            discard(losers)
            return shown
        again = shown.join(losers.withColumn("lost", F.lit(1)), ["kind", "norm"], "left").select("kind", "norm", (F.col("attempt") + F.coalesce("lost", F.lit(0))).alias("attempt"))
        tried, shown = shown, materialise(with_surrogate(again, key), "pii-tries")
        discard(losers, tried)
    raise RuntimeError(f"entities still share surrogates after {rounds} rounds")


def mention_table(mentions: DataFrame, key: str) -> DataFrame:
    """(m, r, names): each distinct mention, what takes its place, and for persons (name, surrogate) of each name."""
    typed = mentions.withColumn("is", kind_of(F.col("m"))).withColumn("e", normal_entities(F.col("m"), F.col("is")))
    entities = materialise(typed.select("m", "is", F.posexplode("e").alias("i", "e")).select("m", "is", "i", "e.kind", "e.norm"), "pii-mentions")
    chosen = distinct_surrogates(entities.select("kind", "norm").distinct(), key)
    put = entities.join(chosen.select("kind", "norm", "s"), ["kind", "norm"]).groupBy("m", "is").agg(F.sort_array(F.collect_list(F.struct("i", "s"))).alias("c"))
    put = put.withColumn("c", F.col("c.s"))
    words = F.slice(person_words(F.col("m")), F.lit(2), F.size("c"))
    pairs = F.when(F.col("is") == "person", F.zip_with(words, "c", lambda w, s: F.struct(w.alias("w"), cased(w, s).alias("s"))))
    out = materialise(put.select("m", written(F.col("m"), F.col("is"), F.col("c")).alias("r"), pairs.alias("names")), "pii-written")
    discard(entities, chosen)
    return out


#: Where one run of letters ends or begins.
WORD_EDGE = r"(?<=\p{L})(?![\p{L}])|(?<![\p{L}])(?=\p{L})"
#: For tests and trials only: whoever knows the key can test a guess of an original.
TRIAL_KEY = "surrogate-key-1"


def key_of(spark: SparkSession) -> str:
    """The secret of the surrogates: the session's spark.strandline.surrogateKey. Without one, a key for trials, with a warning."""
    key = spark.conf.get("spark.strandline.surrogateKey", None)
    if not key:
        warnings.warn("spark.strandline.surrogateKey is not set: surrogates are made with a public key for trials", stacklevel=2)
    return key or TRIAL_KEY


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every detected entity in text replaced, and n_entities (int) appended.

    A null text stays null with 0 entities; an empty one stays empty. Rows are neither dropped nor
    merged; repeated rows get equal texts, rows of one id or of none with unlike texts are told apart. An
    empty table gives an empty one. n_chars, if there, is set to the new length. Columns named
    n_entities or beginning with __pii are replaced. n_entities does not count untitled names.
    """
    names = [c for c in docs.columns if c != "n_entities" and not c.startswith("__pii")]
    text = F.col(f"`{text_col}`")
    this = F.xxhash64(f"`{id_col}`", f"`{text_col}`")
    found = F.when(may_hold(text), F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1))).otherwise(F.array().cast("array<string>"))
    held = docs.where(may_hold(text)).select(this.alias("__pii_row"), F.explode(found).alias("m")).distinct()
    held = materialise(held, "pii-held")
    table = mention_table(held.select("m").distinct(), key)
    own_names = F.map_from_entries(F.aggregate(F.flatten(F.collect_list("names")), F.array().cast("array<struct<w:string,s:string>>"), lambda acc, x: F.when(F.exists(acc, lambda y: y["w"] == x["w"]), acc).otherwise(F.concat(acc, F.array(x)))))
    by_doc = held.join(table, "m").groupBy("__pii_row").agg(F.map_from_entries(F.collect_list(F.struct("m", "r"))).alias("__pii_map"), own_names.alias("__pii_names"))
    base = docs.select(*[F.col(f"`{c}`") for c in names], F.coalesce(found, F.array().cast("array<string>")).alias("__pii_found"))
    # Only rows with entities are joined, and so shuffled.
    plain = base.where(F.size("__pii_found") == 0).withColumn("__pii_text", text)
    joined = base.where(F.size("__pii_found") > 0).withColumn("__pii_row", this).join(by_doc, "__pii_row")
    # Between the entities, the names of the document's persons are replaced word by word.
    renamed = lambda p: F.array_join(F.transform(F.split(p, WORD_EDGE), lambda w: F.coalesce(F.element_at("__pii_names", w), w)), "")
    between = F.split(text, ANY, -1)
    between = F.when(F.size("__pii_names") > 0, F.transform(between, renamed)).otherwise(between)
    pieces = F.zip_with(between, F.transform("__pii_found", lambda m: F.element_at("__pii_map", m)), lambda p, r: F.concat(p, F.coalesce(r, F.lit(""))))
    joined = joined.withColumn("__pii_text", F.array_join(pieces, "")).drop("__pii_row", "__pii_map", "__pii_names")
    out = plain.unionByName(joined)
    columns = []
    for c in names:
        if c == text_col:
            columns.append(F.col("__pii_text").alias(c))
        elif c == "n_chars":
            columns.append(F.length("__pii_text").cast(docs.schema["n_chars"].dataType).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return out.select(*columns, F.size("__pii_found").alias("n_entities"))
