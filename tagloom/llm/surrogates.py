"""Surrogates for personal data, in DataFrame functions only.

Detected entities (e-mail, phone, card, bank account, social security and IP
numbers, access keys, secrets after a key word, names after a title) are
replaced by made-up values of the same type.  A surrogate depends on a secret
key, the type and the entity's canonical form, so every mention of an entity,
in whatever format, gets the same one; it keeps the format of the mention:
separators, letter case, country code, card issuer digit, key prefix, title,
and for names gender and script.

A name is keyed on itself, not on its title: its last word has one surrogate
wherever it stands, so ``Mr Smith``, ``Dr Smith`` and ``Dr Kim Smith`` share
it, and the words before it have one by the whole name.  A name of several
words that a title has introduced is also replaced where it stands without
one, later or earlier in that text (a last word alone is not, as it may be a common
word).  Given names fit the gender of the title, or else of the name's other
titles in that text.  Scripts: Latin, Cyrillic and Greek; others get Latin.

Surrogates are checked: within a type, no two entities may share one, and none
may be an entity of the corpus.  An entity that loses tries again with the
next attempt number; almost all keep attempt 0, which needs no lookup when
texts are rewritten.  Only the rare others reach the texts by a join.  A format
may hold no free value (all one-digit mailboxes are taken, say), so after GROW
attempts a surrogate gets longer by a sign with each (an address becomes one of
the longer kind): there is always a free one, and both checks hold in every
round.

Defined cases: null and empty texts stay as they are; repeated rows are
rewritten alike; texts of any length are rewritten whole (repeats in
patterns are bounded or possessive); an empty table gives an empty result; other columns pass
through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import OWN, staged, text_bytes
from tagloom.operators.broadcast import maybe_broadcast

KEY = "replace-this-key"  # parameter: the owner's secret
GROW = 6  # attempts within an entity's own format; each one after them makes the surrogate a sign longer

# Key words and titles whose next word is an entity.
SECRET_WORDS = "password|passwd|pwd|secret|token|api_key|apikey"
FEMALE_TITLES = "Mrs|Ms|Miss|Frau|Sra|Señora|Mme|Madame|Signora|г-жа"
MALE_TITLES = "Mr|Herr|Sr|Señor|Monsieur|Signor|г-н"
NEUTRAL_TITLES = "Dr|Prof"

_HEAD_SECRET = rf"(?i:{SECRET_WORDS})\s{{0,3}}[=:]\s{{0,3}}[\"']?"
_HEAD_NAME = rf"(?:{FEMALE_TITLES}|{MALE_TITLES}|{NEUTRAL_TITLES})\.? "
# Possessive repeats need no stack, so runs of any length are matched whole.
_NAME_WORD = r"\p{Lu}(?:[\p{L}\p{M}]++|(?=['’]\p{L}))(?:['’](?!s(?!\p{L}))\p{L}[\p{L}\p{M}]*+)*+"
_NAME = rf"{_NAME_WORD}(?:[ -]{_NAME_WORD})*+"
_SECRET = r"(?=[A-Za-z0-9+/_\-]{8})[A-Za-z0-9+/_\-]++(?:[.=]++[A-Za-z0-9+/_\-]++)*+"
_COUNTRY = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

PATTERN = "|".join(
    [
        rf"(?<![\w]){_HEAD_SECRET}{_SECRET}",
        r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
        r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}+@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){0,8}\.[A-Za-z]{2,24}",
        r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d)",
        r"(?<![\w.\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
        r"(?<![\w.\-])(?:\d{13,19}|\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3})(?![\w\-])",
        r"(?<![\w.])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?![\w\-])",
        r"(?<![\w.])\+\d{1,3}(?:[ .\-]\d{2,4}){2,5}(?![\w\-])",
        r"(?<![\w.])\+\d{8,15}(?![\w\-])",
        rf"(?<![\w]){_HEAD_NAME}{_NAME}",
    ]
)

# First names by gender and script; last names are built from syllables.
FIRST_NAMES = {
    ("f", "latin"): "Anna Clara Elena Emma Greta Helena Ida Julia Laura Lena Maria Nora Olga Paula Rosa Sara".split(),
    ("m", "latin"): "Adam Anton Bruno David Emil Felix Hugo Jonas Karl Leo Martin Oscar Paul Robert Simon Victor".split(),
    ("n", "latin"): "Alex Andrea Charlie Chris Eden Jamie Jordan Kim Morgan Noa Robin Sam Sasha Taylor Toni Yuri".split(),
    ("f", "cyrillic"): "Анна Вера Дарья Елена Ирина Лидия Мария Нина Ольга Полина Раиса София".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Максим Николай Олег Павел".split(),
    ("n", "cyrillic"): "Саша Женя Валя Слава Шура Паша Мика Ника Тони Робин Алекс Крис".split(),
    ("f", "greek"): "Άννα Ελένη Μαρία Σοφία Ειρήνη Κατερίνα Δήμητρα Βασιλική".split(),
    ("m", "greek"): "Γιώργος Νίκος Κώστας Γιάννης Δημήτρης Πέτρος Παύλος Αντώνης".split(),
    ("n", "greek"): "Άλεξ Σάσα Ρόμπιν Κιμ Τζο Μπίλι Σάμι Κρις".split(),
}  # of one script, lists are disjoint and equally long: a place in them tells names apart whatever the gender
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve".split(),
    "cyrillic": "ба бе бо ва ве га го да де до жа за зо ка ке ко ла ле ло ма ме мо на не но па пе ра ре ро са се со та те".split(),
    "greek": "βα βε βο γα γο δα δε δο ζα κα κε κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε το".split(),
}
SCRIPTS = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}  # all others: latin


# --- what a match is ----------------------------------------------------------------


def entity_type(m: Column) -> Column:
    def title(names):
        return m.rlike(rf"^(?:{names})\.? ")

    return (
        F.when(m.rlike(rf"^{_HEAD_SECRET}"), "secret")
        .when(m.rlike(r"^AKIA[0-9A-Z]{16}$"), "access_key")
        .when(m.contains("@"), "email")
        .when(m.rlike(r"^[A-Z]{2}\d{2}[ A-Z0-9]+$"), "bank_account")
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "social_security")
        .when(m.rlike(r"^(\d{13,19}|\d{4}([ \-]\d{4}){3})$"), "card")
        .when(m.rlike(r"^[+(\d]"), "phone")
        .when(title(FEMALE_TITLES), "name_f")
        .when(title(MALE_TITLES), "name_m")
        .otherwise("name_n")
    )


def head(m: Column, kind: Column) -> Column:
    """The part of a mention that stays in front: key word, title, key prefix, or country code."""
    digits = F.length(F.regexp_replace(m, r"\D", ""))
    return (
        F.when(kind == "secret", F.regexp_extract(m, rf"^{_HEAD_SECRET}", 0))
        .when(kind == "access_key", F.lit("AKIA"))
        .when(kind == "bank_account", F.substring(m, 1, 2))
        .when((kind == "phone") & (digits > 10) & m.rlike(r"^\+\d+$"), F.regexp_extract(m, rf"^\+{_COUNTRY}", 0))
        .when((kind == "phone") & (digits > 10), F.regexp_extract(m, r"^\+?\d{1,3}[ .\-]?", 0))
        .when(kind.startswith("name"), F.regexp_extract(m, rf"^{_HEAD_NAME}", 0))
        .otherwise("")
    )


def canonical(core: Column, kind: Column) -> Column:
    """What all mentions of an entity share."""
    return (
        F.when(kind.isin("card", "phone", "social_security"), F.regexp_replace(core, r"\D", ""))
        .when(kind == "bank_account", F.regexp_replace(core, " ", ""))
        .when(kind.startswith("name"), F.translate(F.lower(core), "’", "'"))
        .when(kind == "email", F.lower(core))
        .otherwise(core)
    )


# --- surrogates -----------------------------------------------------------------------


def _byte(stream: Column, i) -> Column:
    """i-th byte of a hex stream of 64 bytes, repeated."""
    return F.conv(F.substring(stream, F.pmod(i, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(stream: Column, i, of: list[str]) -> Column:
    n = F.conv(F.substring(stream, F.lit(8 * i + 1), F.lit(8)), 16, 10).cast("long")
    return F.element_at(F.array(*[F.lit(x) for x in of]), (F.pmod(n, F.lit(len(of))) + 1).cast("int"))


def _letters(text: Column, stream: Column, hexadecimal: Column) -> Column:
    """Each digit and letter replaced by one of its kind; the rest stays."""

    def one(c, i):
        b = _byte(stream, i)
        a_z = F.when(hexadecimal, F.lit(6)).otherwise(F.lit(26))

        def nth(alphabet: str, n) -> Column:
            return F.substring(F.lit(alphabet), F.pmod(b, n) + 1, F.lit(1))

        low, up = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        return (
            F.when(c.rlike("^[0-9]$"), nth("0123456789", F.lit(10)))
            .when(c.rlike("^[a-z]$"), nth(low, a_z))
            .when(c.rlike("^[A-Z]$"), nth(up, a_z))
            .otherwise(c)
        )

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, one), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string (the last digit counts once)."""
    ds = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")

    def value(c, i):
        d = c.cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(ds, value), F.lit(0), lambda a, x: a + x)


def _card(canon: Column, stream: Column, valid: Column) -> Column:
    """Issuer digit and length stay; a ``valid`` card number (its check digit is right) gets a right check digit."""
    body = F.concat(F.substring(canon, 1, 1), _letters(canon.substr(F.lit(2), F.length(canon) - 2), stream, F.lit(False)))
    check = F.pmod(F.lit(10) - F.pmod(_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    last = F.when(valid, check).otherwise(F.pmod(check + 1 + F.pmod(_byte(stream, F.lit(63)), F.lit(9)), F.lit(10)))
    return F.concat(body, last.cast("string"))


def _by_script(text: Column, made) -> Column:
    """``made(script)`` of the script of a text."""
    out = made("latin")
    for script, sign in SCRIPTS.items():
        out = F.when(text.rlike(sign), made(script)).otherwise(out)
    return out


def _last_name(canon: Column, attempt: Column, stream: Column) -> Column:
    """A built name of the script, a syllable longer with each attempt: the names never run out."""

    def made(script):
        n = F.array(*[F.lit(x) for x in SYLLABLES[script]])
        parts = F.transform(
            F.sequence(F.lit(1), attempt + 3),
            lambda i: F.element_at(n, (F.pmod(F.xxhash64(stream, i), F.size(n)) + 1).cast("int")),
        )
        return F.initcap(F.array_join(parts, ""))

    return _by_script(canon, made)


def _given_places(canon: Column, attempt: Column, stream: Column) -> Column:
    """``last name|places``: for each given word the places of its names in the lists, one more with each attempt.

    Places that would show a given word of the entity itself give ``canon``, which is a real entity, so they lose.
    """
    given = F.substring_index(canon, "|", -1)
    words = F.split(given, " ")

    def made(script):
        size = len(FIRST_NAMES["n", script])
        one = lambda at, i: F.pmod(F.xxhash64(stream, at, i), F.lit(size)).cast("string")
        word = lambda w, at: F.array_join(F.transform(F.sequence(F.lit(0), attempt), lambda i: one(at, i)), "-")
        # held in a variable: it is looked at four times
        places = F.array(F.array_join(F.transform(words, word), " "))
        own = F.split(given, "[ -]")

        def checked(p):
            shown = F.concat_ws(" ", *[_shown(script, p, g) for g in "fmn"])
            return F.when(F.arrays_overlap(F.split(F.lower(shown), "[ -]"), own), canon).otherwise(
                F.concat(F.substring_index(canon, "|", 1), F.lit("|"), p)
            )

        return F.get(F.transform(places, checked), F.lit(0))

    return _by_script(given, made)


def _shown(script: str, places: Column, gender: str) -> Column:
    n = F.array(*[F.lit(x) for x in FIRST_NAMES[gender, script]])
    word = lambda w: F.array_join(F.transform(F.split(w, "-"), lambda x: F.element_at(n, x.cast("int") + 1)), "-")
    return F.array_join(F.transform(F.split(places, " "), word), " ")


def given_names(canon: Column, new: Column, gender: Column) -> Column:
    """The given names that ``new`` (see ``_given_places``) stands for."""

    def held(v):
        def made(script):
            f, m, n = (_shown(script, v["places"], g) for g in "fmn")
            return F.when(v["gender"] == "f", f).when(v["gender"] == "m", m).otherwise(n)

        return _by_script(F.substring_index(canon, "|", -1), made)

    places = F.substring_index(new, "|", -1)
    return F.get(F.transform(F.array(F.struct(places.alias("places"), gender.alias("gender"))), held), F.lit(0))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The canonical form of the entity's replacement (``last name|places`` for given names)."""
    held = F.struct(
        _seeded(kind, canon, attempt, key).alias("stream"),
        grown(canon, kind, attempt).alias("canon"),
        (~canon.rlike("[g-zG-Z]")).alias("hex"),
        F.when(kind == "card", F.pmod(_luhn_sum(canon), F.lit(10)) == 0).alias("valid"),
    )
    # held in a variable, so what depends on the whole entity is found once, not for each of its letters
    return F.when(kind.startswith("name"), name_surrogate(kind, canon, attempt, key)).otherwise(F.get(
        F.transform(F.array(held), lambda v: _made(kind, v["canon"], attempt, v["stream"], v["hex"], v["valid"])), F.lit(0)
    )
    )


def name_surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """``surrogate`` of kinds name (a last name) and name_given."""
    return F.get(F.transform(F.array(_seeded(kind, canon, attempt, key)), lambda stream: (
        F.when(kind == "name_given", _given_places(canon, attempt, stream)).otherwise(_last_name(canon, attempt, stream))
    )), F.lit(0))


def _seeded(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string")), 512)


def grown(canon: Column, kind: Column, attempt: Column) -> Column:
    """The form whose signs are replaced: longer by one with each attempt after the first GROW."""
    more = F.greatest(attempt - (GROW - 1), F.lit(0))
    digits, letters = F.repeat(F.lit("0"), more), F.repeat(F.lit("a"), more)
    at = F.instr(canon, "@")

    def within(place: Column, extra: Column) -> Column:
        return F.concat(canon.substr(F.lit(1), place), extra, canon.substr(place + 1, F.length(canon)))

    longer = (
        F.when(kind == "email", within(at - 1, letters))
        .when(kind == "card", within(F.length(canon) - 1, digits))  # the check digit stays last
        .when(kind.isin("phone", "social_security"), F.concat(canon, digits))
        .when(kind.isin("bank_account", "access_key"), F.concat(canon, F.upper(letters)))
        .when(kind == "secret", F.concat(canon, letters))
        .otherwise(canon)
    )
    return F.when(attempt < GROW, canon).otherwise(longer)


def _made(kind: Column, canon: Column, attempt: Column, stream: Column, hexadecimal: Column, valid: Column) -> Column:
    short_ip = F.concat_ws(".", *[(F.pmod(_byte(stream, F.lit(i)), F.lit(254)) + 1).cast("string") for i in range(4)])
    long_ip = F.concat_ws(":", F.lit("2001:db8"), *[F.substring(stream, 1 + 4 * i, 4) for i in range(6)])  # fixed value: for documents
    ip = F.when(attempt < GROW, short_ip).otherwise(long_ip)
    at = F.instr(canon, "@")
    dot = F.length(canon) - F.instr(F.reverse(canon), ".") + 1  # the last dot: what follows stays
    email = F.concat(
        _letters(canon.substr(F.lit(1), dot - 1), stream, F.lit(False)), canon.substr(dot, F.length(canon))
    )
    phone = F.concat(
        (F.pmod(_byte(stream, F.lit(40)), F.lit(8)) + 2).cast("string"),
        _letters(canon.substr(F.lit(2), F.length(canon)), stream, F.lit(False)),
    )
    return (
        F.when(kind == "ip", ip)
        .when((kind == "email") & (at > 0), email)
        .when(kind == "card", _card(canon, stream, valid))
        .when(kind == "phone", phone)
        .otherwise(_letters(canon, stream, hexadecimal & (kind == "secret")))
    )


def render(core: Column, kind: Column, new: Column) -> Column:
    """``new`` (canonical) in the format of the mention ``core``."""
    plain = kind.isin("card", "phone", "social_security", "bank_account")
    chars = F.filter(F.split(core, ""), lambda c: c != "")
    # the n-th digit or letter of the mention becomes the n-th of the new form
    place = F.length(F.regexp_replace(core, "[^0-9A-Za-z]", ""))

    def put(c, i):
        before = F.length(F.regexp_replace(core.substr(F.lit(1), i), "[^0-9A-Za-z]", ""))
        return F.when(c.rlike("^[0-9A-Za-z]$"), F.substring(new, before + 1, F.lit(1))).otherwise(c)

    rest = new.substr(place + 1, F.length(new))  # of a surrogate that is longer than the mention
    spaced = F.when(place == F.length(core), new).otherwise(F.concat(F.array_join(F.transform(chars, put), ""), rest))

    def same_case(c, i):
        n = F.substring(new, i + 1, F.lit(1))
        return F.when(c.rlike("^[A-Z]$"), F.upper(n)).otherwise(n)

    cased = F.when((core == F.lower(core)) | (F.length(core) != F.length(new)), new).otherwise(F.array_join(F.transform(chars, same_case), ""))
    return F.when(plain, spaced).when(kind == "email", cased).otherwise(new)


# --- on Spark ---------------------------------------------------------------------------


def _described(m: Column) -> Column:
    """(kind, head, core, canon) of a match."""
    kind = entity_type(m)
    h = head(m, kind)
    core = m.substr(F.length(h) + 1, F.length(m))
    return F.struct(kind.alias("kind"), h.alias("head"), core.alias("core"), canonical(core, kind).alias("canon"))


def _given(d: Column) -> Column:
    """What stands before the last word of a name, null for a name of one word."""
    return F.when(d["canon"].contains(" "), F.regexp_replace(d["canon"], " [^ ]*$", ""))


def _parts(d: Column) -> Column:
    """The entities of a mention, as (kind, canon): a name has its last word, and the whole of its words if there are more."""

    def part(kind, canon):
        return F.struct(kind.alias("kind"), canon.alias("canon"))

    last = F.substring_index(d["canon"], " ", -1)
    return (
        F.when(~d["kind"].startswith("name"), F.array(part(d["kind"], d["canon"])))
        .when(_given(d).isNull(), F.array(part(F.lit("name"), last)))
        .otherwise(F.array(part(F.lit("name"), last), part(F.lit("name_given"), F.concat(last, F.lit("|"), _given(d)))))
    )


def _introduced(d: Column) -> Column:
    """Distinct names of several words among the mentions of a text, longest first."""
    names = F.filter(d, lambda x: x["kind"].startswith("name") & x["canon"].contains(" "))
    return F.array_sort(
        F.array_distinct(F.transform(names, lambda x: x["core"])), lambda a, b: F.length(b) - F.length(a)
    )


def _titled(d: Column, kind: str) -> Column:
    return F.array_distinct(F.transform(F.filter(d, lambda x: (x["kind"] == kind) & x["canon"].contains(" ")), lambda x: x["canon"]))


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct (kind, canon) of all texts."""
    m = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(PATTERN), F.lit(0)))).alias("m"))
    m = m.distinct()
    d = m.select(_described(F.col("m")).alias("d"))
    return d.select(F.explode(_parts(F.col("d"))).alias("e")).select("e.kind", "e.canon").distinct()


def attempts(found: DataFrame, key: str = KEY) -> DataFrame | None:
    """(kind, canon, attempt) of the entities that do not keep attempt 0; None if all do."""
    kind, canon = F.col("kind"), F.col("canon")
    everyone = staged(found.withColumn("new", surrogate(kind, canon, F.lit(0), key)), "pii-entities")
    state = everyone.withColumn("attempt", F.lit(0))
    moved = None
    turn = 0
    while True:  # surrogates grow, so every entity finds a free one
        losers = staged(_losers(state, everyone), "pii-losers")
        if losers.isEmpty():
            return moved
        again = losers.select("kind", "canon", surrogate(kind, canon, F.lit(turn + 1), key).alias("new"), F.lit(turn + 1).alias("attempt"))
        kept = state.join(losers.select("kind", "canon"), ["kind", "canon"], "left_anti")
        state = staged(kept.unionByName(again), "pii-attempts")
        moved = state.filter("attempt > 0").select("kind", "canon", "attempt")
        turn += 1


def _losers(state: DataFrame, real: DataFrame) -> DataFrame:
    """Entities whose surrogate, in whatever letter case for names, is taken by another (the earlier attempt, then the smaller form, keeps
    it), is a real entity, or is the entity itself."""
    # canonical names are lower-cased, surrogates of names are not
    state = state.withColumn("new", F.when(F.col("kind").startswith("name"), F.lower("new")).otherwise(F.col("new")))
    claims = state.select("kind", "new", F.struct("attempt", "canon").alias("who"), F.lit(False).alias("is_real"))
    none = F.lit(None).cast("struct<attempt:int,canon:string>")
    claims = claims.unionByName(real.select("kind", F.col("canon").alias("new"), none.alias("who"), F.lit(True).alias("is_real")))
    contested = (
        claims.groupBy("kind", "new")
        .agg(F.count("who").alias("n"), F.min("who").alias("first"), F.bool_or("is_real").alias("real"))
        .filter("n > 1 or (n = 1 and real)")
    )
    j = state.join(contested, ["kind", "new"])
    return j.filter(F.col("real") | (F.col("canon") != F.col("first.canon"))).select("kind", "canon")


def replace_entities(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", key: str = KEY) -> DataFrame:
    """``docs`` with rewritten texts and OWN-prefixed n (number of replaced mentions) and kinds.

    ``length_col``, where present, is set to the new number of characters of
    rewritten texts.
    """
    moved = attempts(entities(docs, text_col), key)
    text = F.col(text_col)
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    out = docs.withColumn(OWN + "m", F.coalesce(found, F.array().cast("array<string>")))
    # texts that introduce names of several words are searched once more, for these names too
    out = out.withColumn(OWN + "names", _introduced(F.transform(F.col(OWN + "m"), _described)))
    more = F.size(OWN + "names") > 0
    bare = F.concat(F.lit(rf"{PATTERN}|(?<![\p{{L}}\p{{M}}])(?:"), F.array_join(OWN + "names", "|"), F.lit(r")(?!-?[\p{L}\p{M}])"))
    out = out.withColumn(OWN + "bare", F.when(more, bare))
    out = out.withColumn(OWN + "m", F.when(more, F.regexp_extract_all(text, F.col(OWN + "bare"), F.lit(0))).otherwise(F.col(OWN + "m")))
    if moved is not None:
        out = _with_attempts(out, moved, text_col)
    out = out.withColumn(OWN + "d", F.transform(F.col(OWN + "m"), _described))
    for g in "fm":
        out = out.withColumn(f"{OWN}titled_{g}", _titled(F.col(OWN + "d"), f"name_{g}"))

    def made(kind, canon):
        attempt = F.lit(0)
        if moved is not None:
            attempt = F.coalesce(F.element_at(F.col(OWN + "moved"), F.concat_ws("|", kind, canon)), F.lit(0))
        return surrogate(kind, canon, attempt, key)

    def gender(d):
        f, m = (F.array_contains(F.col(f"{OWN}titled_{g}"), d["canon"]) for g in "fm")
        own = F.when(d["kind"] == "name_f", "f").when(d["kind"] == "name_m", "m")
        return F.coalesce(own, F.when(f & ~m, "f").when(m & ~f, "m"), F.lit("n"))

    def put(d):
        last = F.substring_index(d["canon"], " ", -1)
        whole = F.concat(last, F.lit("|"), _given(d))
        given = F.concat(given_names(whole, made(F.lit("name_given"), whole), gender(d)), F.lit(" "))
        name = F.concat(F.coalesce(given, F.lit("")), made(F.lit("name"), last))
        new = F.when(d["kind"].startswith("name"), name).otherwise(render(d["core"], d["kind"], made(d["kind"], d["canon"])))
        return F.concat(d["head"], new)

    some = F.size(F.col(OWN + "m")) > 0
    new = F.transform(F.col(OWN + "d"), put)
    out = out.withColumn(OWN + "new", F.when(some, new))
    parts = F.when(F.col(OWN + "bare").isNull(), F.split(text, PATTERN, -1)).otherwise(F.split(text, F.col(OWN + "bare"), -1))
    joined = F.array_join(
        F.transform(parts, lambda p, i: F.concat(p, F.coalesce(F.get(F.col(OWN + "new"), i), F.lit("")))), ""
    )
    out = out.withColumn(OWN + "text", F.when(some, joined))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.coalesce(F.col(OWN + "text"), F.col(c)).alias(c))
        elif c == length_col:
            n = F.length(F.col(OWN + "text")).cast(docs.schema[c].dataType)
            cols.append(F.when(some, n).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(
        *cols,
        F.size(F.col(OWN + "m")).alias(OWN + "n"),
        F.array_sort(F.array_distinct(F.transform(F.col(OWN + "d"), lambda d: d["kind"]))).alias(OWN + "kinds"),
    )


def _with_attempts(docs: DataFrame, moved: DataFrame, text_col: str) -> DataFrame:
    """Adds the attempts of the few entities that moved, as a map per text that holds one."""
    t = text_bytes(F.col(text_col))
    k1, k2 = F.xxhash64(t), F.xxhash64(F.lit(17), t)
    d = F.transform(F.col(OWN + "m"), _described)
    mentions = docs.select(k1.alias("k1"), k2.alias("k2"), F.explode(F.array_distinct(d)).alias("d"))
    mentions = mentions.select("k1", "k2", F.explode(_parts(F.col("d"))).alias("e")).select("k1", "k2", "e.kind", "e.canon")
    side, _ = maybe_broadcast(moved)
    held = (
        mentions.join(side, ["kind", "canon"])
        .groupBy("k1", "k2")
        .agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "canon").alias("key"), "attempt"))).alias(OWN + "moved"))
    )
    held = staged(held.select(F.col("k1").alias(OWN + "k1"), F.col("k2").alias(OWN + "k2"), OWN + "moved"), "pii-moved")
    held, _ = maybe_broadcast(held)
    return docs.join(held, (k1 == F.col(OWN + "k1")) & (k2 == F.col(OWN + "k2")), "left").drop(OWN + "k1", OWN + "k2")
