"""Personal data replaced by surrogates.

Entities found in texts get replacements that are keyed (the same key gives
the same ones, none can be recomputed without it), of the same kind and
format, distinct for distinct entities, and the same wherever an entity
occurs: names keep their titles, their gender, initials, particles and script (a last name alone
or without a title is linked to the titled full name of its text), numbers their
punctuation, card numbers and IBANs their check digits' validity, addresses
their shape, private ones their network.

Replacements are made once per distinct entity, from a keyed digest and an
attempt number.  A candidate that another entity has, or that is itself an
entity of the corpus, is drawn again with the next attempt.  DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import let, stored

#: Titles; a name may have several ("Herr Dr.").
_TITLES = (r"(?:(?:Mr|Mrs|Ms|Mx|Miss|Dr|Prof|MR|MRS|MS|DR|Sir|Professor|Herr|Frau|Doktor|Monsieur|Madame|Mademoiselle|Mme|Mlle"
           r"|Professeure?|Señor|Señora|Señorita|Sr|Sra|Srta)\.?|(?<!\.)M\.|[Гг]-н|[Гг]-жа)")
#: A word of a name: inner capitals, apostrophes before a capital, hyphens.
_WORD = r"(?:[dl]['’])?\p{Lu}\p{L}*+(?:['’]\p{Lu}\p{L}*+)*+"
#: Initials and particles may stand before any word.
_LEAD = (r"(?:\p{Lu}\. ?)*(?:(?:van|von|vom|der|den|de|del|della|di|da|dos|das|do|du|des|la|las|los|le|el|al|bin|ibn|ter|ten|zu|zum|y) )*")
_NAME = rf"{_LEAD}{_WORD}(?:-{_WORD})*+"
#: Kinds in the order in which they are tried; no group captures.
KINDS: dict[str, str] = {
    "secret": r"(?<![\p{L}\p{N}_-])(?:[0-9a-fA-F]{32,}|AKIA[0-9A-Z]{16}|AIza[A-Za-z0-9_-]{35}|sk-[A-Za-z0-9_-]{16,}"
              r"|[srp]k_(?:live|test)_[A-Za-z0-9]{10,}|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_-]{16,}|gh[pousr]_[A-Za-z0-9]{30,}"
              r"|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"
              r"|-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[^-]++(?:-(?!----)[^-]*+)*+-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----)(?![\p{L}\p{N}])",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?)(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{L}\p{N}.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "ip6": r"(?<![\p{L}\p{N}:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
           r"|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![\p{L}\p{N}:]|\.[0-9])",
    # +1 and ten digits; other countries; area code in brackets; national with
    # a leading 0 (but no date); groups as written in America and in Spain
    "phone": r"(?<![\p{L}\p{N}+])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
             r"|(?:\+|00)[1-9](?:[ ./()-]{0,2}[0-9]){7,14}"
             r"|\([0-9]{2,5}\)(?:[ .-]?[0-9]){6,8}"
             r"|(?![0-9]{2}[./-][0-9]{2}[./-](?:19|20)[0-9]{2}(?![0-9]))0[1-9](?:[ ./-]?[0-9]){7,9}"
             # neither years one after the other nor thousands
             r"|(?!(?:(?:19|20)[0-9]{2}[ .-]){2}(?:19|20)[0-9]{2}(?![0-9]))(?![0-9]{2}(?:[ .][0-9]{3}){2}(?![0-9]))"
             r"(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3,4}[ .-][0-9]{3,4}"
             r"|[6-9][0-9]{2}(?:[ .-][0-9]{2}){3}|[2-9][0-9]{2}[2-9][0-9]{6})(?![\p{L}\p{N}])",
    "name": rf"(?<!\p{{L}})(?:{_TITLES} )+{_NAME}(?: {_NAME})*+",
}
#: No kind may follow a letter: said once, so that most characters fail at once.
ANY = r"(?<!\p{L})(?:" + "|".join(KINDS.values()) + ")"
#: What names need: a title's first letter is looked for before all titles.
TITLED = rf"(?=[DHMPSГг])(?<!\p{{L}}){_TITLES} \p{{L}}"


def may_have(text: Column) -> Column:
    """Whether ``text`` has what any kind needs; cheaper than ``ANY``."""
    return text.rlike("[0-9@]") | text.contains("PRIVATE KEY-----") | text.rlike(TITLED)


#: What a phone number keeps: its country code or the 0 it starts with.
PREFIX = (r"^(?:(?:\+|00)(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})|0)?")
#: Titles that tell a gender (others: none is shown).
FEMALE = r"^(?:Mrs|Ms|MRS|MS|Miss|Frau|Madame|Mademoiselle|Mme|Mlle|Professeure|Señora|Señorita|Sra|Srta|[Гг]-жа)(?!\p{L})"
MALE = r"^(?:Mr|MR|M|Sir|Herr|Monsieur|Señor|Sr|[Гг]-н)(?!\p{L})"
#: A name's titles, with what separates them from the name.
TITLE = rf"^(?:{_TITLES} )+"
GENDERS = ("female", "male", "none")
#: Syllables of made-up names by script, and endings by gender.
SYLLABLES = {"latin": "ba be bi bo da de di do fa fe ka ke ki la le li lo ma me mi mo na ne ni no pa ra re ri ro sa se si ta te ti to va ve vi".split(),
             "cyrillic": "ба бе би бо да де ди до ка ке ки ла ле ли ло ма ме ми мо на не ни но па ра ре ри ро са се си та те ти то ва ве ви".split(),
             "greek": "βα βε βι βο δα δε δι δο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σι σο τα τε τι το".split()}
ENDINGS = {"latin": {"female": "na", "male": "rn", "none": "s"}, "cyrillic": {"female": "на", "male": "рн", "none": "с"},
           "greek": {"female": "να", "male": "ρος", "none": "ς"}}
MAX_ATTEMPTS = 12
#: Attempts in an entity's own length; each later one is a character longer
#: where the kind allows it (e-mail names, secrets, phone numbers).
OWN_LENGTH = 4
#: First and last line of a private key.
KEY_LINES = (r"^(?:-----[A-Z0-9 ]+-----)?", r"(?:-----[A-Z0-9 ]+-----)?$")


def kind_of(entity: Column) -> Column:
    out = F.lit("name")
    for kind, pattern in reversed(list(KINDS.items())):
        out = F.when(entity.rlike("^(?:" + pattern + ")$"), kind).otherwise(out)
    return out


def canonical(kind: Column, entity: Column) -> Column:
    """What makes two mentions the same entity: numbers without punctuation,
    addresses without case."""
    compact = F.regexp_replace(entity, r"[ ()./-]", "")
    return (F.when(kind.isin("card", "ssn", "phone", "iban"), compact)
            .when(kind.isin("email", "ip6"), F.lower(entity)).otherwise(entity))


def _luhn(number: Column) -> Column:
    return F.call_function("luhn_check", number)


def _iban_check(number: Column) -> Column:
    """The check digits that make an IBAN valid: 98 less the remainder by 97 of
    its rest, read as a number with A = 10 to Z = 35."""
    moved = F.concat(F.substr(number, F.lit(5)), F.substr(number, F.lit(1), F.lit(2)), F.lit("00"))
    rest = F.aggregate(F.regexp_extract_all(moved, F.lit("[A-Z0-9]"), F.lit(0)), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97)
    return F.lpad((98 - rest).cast("string"), 2, "0")


def _stream(key: str, kind: Column, value: Column, attempt: int, length: Column) -> Column:
    """Array of keyed bytes (0-255), at least ``length`` of them: a digest of
    the key and a keyed digest of the entity, block by block."""
    def block(i: Column) -> Column:
        inner = F.sha2(F.concat_ws("|", F.lit(key), kind, F.lit(str(attempt)), i.cast("string"), value), 256)
        return F.sha2(F.concat(F.lit(key), inner), 512)

    digits = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.greatest(length - 1, F.lit(0)) / 64).cast("int")), lambda i: block(i)), "")
    return let(digits, lambda d: F.transform(
        F.sequence(F.lit(0), F.greatest(length, F.lit(32)) - 1),
        lambda i: F.conv(F.substr(d, 2 * i + 1, F.lit(2)), 16, 10).cast("int")))


_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _shaped(value: Column, stream: Column, hexadecimal: Column, keep_before: Column) -> Column:
    """``value`` with each letter and digit drawn anew, case, script of the
    alphabet (Latin letters for any other) and punctuation kept; the first
    ``keep_before`` characters stay."""
    def drawn(c: Column, i: Column) -> Column:
        b = F.element_at(stream, i + 1)
        letter = F.substr(F.lit(_LETTERS), F.when(hexadecimal, b % 6).otherwise(b % 26) + 1, F.lit(1))
        return (F.when(i < keep_before, c).when(c.rlike("[0-9]"), (b % 10).cast("string"))
                .when(c.rlike(r"\p{Lu}"), F.upper(letter)).when(c.rlike(r"\p{L}"), letter).otherwise(c))

    return F.array_join(F.transform(F.split(value, "(?!^)"), drawn), "")


def _candidate(key: str, attempt: int) -> Column:
    """Surrogate of the canonical form ``value`` of ``kind``."""
    kind, value = F.col("kind"), F.col("value")
    more = max(0, attempt - OWN_LENGTH + 1)
    key_block = value.startswith("-----")
    if more:
        value = (F.when(kind == "email", F.concat(F.lit("x" * more), value)).when(kind == "phone", F.concat(value, F.lit("0" * more)))
                 .when((kind == "secret") & ~key_block, F.concat(value, F.lit("a" * more))).otherwise(value))
    no = F.lit(False)
    top = F.length(value) - F.length(F.substring_index(value, ".", -1)) - 1  # an address keeps its top-level domain

    def make(s: Column) -> Column:
        email = F.concat(_shaped(F.substr(value, F.lit(1), top), s, no, F.lit(0)), F.substr(value, top + 1))
        # a private address stays in its private network
        octets = [(F.element_at(s, i) % 254 + 1).cast("string") for i in (1, 2, 3, 4)]
        ip = (F.when(value.rlike(r"^(?:10|127)\."), F.concat_ws(".", F.substring_index(value, ".", 1), *octets[1:]))
              .when(value.rlike(r"^(?:192\.168|169\.254)\."), F.concat_ws(".", F.substring_index(value, ".", 2), *octets[2:]))
              .when(value.rlike(r"^172\.(?:1[6-9]|2[0-9]|3[01])\."),
                    F.concat_ws(".", F.lit("172"), (F.element_at(s, 2) % 16 + 16).cast("string"), *octets[2:]))
              .otherwise(F.concat_ws(".", *octets)))
        iban = let(_shaped(value, s, no, F.lit(2)), lambda n: F.when(
            _iban_check(value) == F.substr(value, F.lit(3), F.lit(2)),
            F.concat(F.substr(n, F.lit(1), F.lit(2)), _iban_check(n), F.substr(n, F.lit(5)))).otherwise(n))
        body = F.substr(value, F.lit(1), F.length(value) - 1)
        card = let(F.concat(_shaped(F.substr(body, F.lit(1), F.length(body) - 1), s, no, F.lit(0)),
                            (F.element_at(s, 32) % 10).cast("string")), lambda b: F.element_at(F.filter(
                                F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(b, d.cast("string"))),
                                lambda n: _luhn(n) == _luhn(value)), F.element_at(s, 31) % F.when(_luhn(value), 1).otherwise(9) + 1))
        secret = let(F.regexp_extract(value, r"^(?:AKIA|AIza|sk-|[srp]k_(?:live|test)_|github_pat_|glpat-|gh[pousr]_|xox[abprs]-|eyJ)?", 0), lambda p: _shaped(
            value, s, value.rlike("^[0-9a-fA-F]+$"), F.length(p)))
        head, tail = (F.regexp_extract(value, line, 0) for line in KEY_LINES)
        inside = F.substr(value, F.length(head) + 1, F.length(value) - F.length(head) - F.length(tail))
        secret = F.when(key_block, F.concat(head, _shaped(inside, s, no, F.lit(0)), tail)).otherwise(secret)
        phone = _shaped(value, s, no, F.length(F.regexp_extract(value, PREFIX, 0)))
        return (F.when(kind == "email", email).when(kind == "ip", ip)
                .when(kind == "ip6", _shaped(value, s, F.lit(True), F.lit(0))).when(kind == "card", card)
                .when(kind == "secret", secret).when(kind == "phone", phone).when(kind == "name", _name(value, s, attempt))
                .when(kind == "iban", iban).otherwise(_shaped(value, s, no, F.lit(0))))

    # a name has at most one word for two characters, of up to 15 syllables
    needed = F.when(kind == "name", 8 * F.length(value) + 8).otherwise(F.length(value))
    return let(_stream(key, kind, value, attempt, needed), make)


def people(titled: Column) -> Column:
    """``gender, name, last`` of the titled names of one text, in their order."""
    def person(raw: Column) -> Column:
        name = F.regexp_replace(raw, TITLE, "")
        gender = F.when(raw.rlike(FEMALE), "female").when(raw.rlike(MALE), "male").otherwise("none")
        return F.struct(gender.alias("gender"), name.alias("name"), F.substring_index(name, " ", -1).alias("last"))

    return F.array_distinct(F.transform(titled, person))


def named_by(known: Column) -> Column:
    """Expression for ``ANY`` and the known names without a title, full names
    first; of what names consist of, only the dot means more in a pattern."""
    names = F.array_distinct(F.concat(F.transform(F.filter(known, lambda k: k["name"] != k["last"]), lambda k: k["name"]),
                                      F.transform(known, lambda k: k["last"])))
    return F.when(F.size(names) == 0, ANY).otherwise(F.concat(
        F.lit(ANY[:-1] + r"|(?<![\p{L}\p{N}])(?:"), F.replace(F.array_join(names, "|"), F.lit("."), F.lit(r"\.")), F.lit(r")(?![\p{L}\p{N}]))")))


def who(raw: Column, known: Column) -> Column:
    """``gender|name`` of a mention among the ``known`` people of its text: the
    full name if one has this last name, and the gender that a title tells,
    the mention's own first."""
    def find(me: Column) -> Column:
        def fits(k: Column) -> Column:
            return (k["gender"] == me["gender"]) | (k["gender"] == "none") | (me["gender"] == "none")

        full = F.filter(known, lambda k: (k["name"] != k["last"]) & (me["name"] == me["last"]) & (k["last"] == me["name"]) & fits(k))
        name = F.coalesce(F.get(full, F.lit(0))["name"], me["name"])
        # one's own title, then those of the same name, then of the last name alone
        told = F.concat(F.filter(known, lambda k: (k["name"] == name) & (k["gender"] != "none")),
                        F.filter(known, lambda k: (k["name"] == k["last"]) & (k["last"] == F.substring_index(name, " ", -1))
                                 & (k["gender"] != "none")))
        gender = F.when(me["gender"] != "none", me["gender"]).otherwise(F.coalesce(F.get(told, F.lit(0))["gender"], F.lit("none")))
        return F.concat_ws("|", gender, name)

    return let(F.get(people(F.array(raw)), F.lit(0)), find)


def _name(value: Column, stream: Column, attempt: int) -> Column:
    """Of ``gender|name``: each word or part of a word made of syllables of its
    script, more of them with each attempt, the first ended by gender.
    Initials stay initials, capitals capitals; particles and hyphens stay."""
    gender, name = F.substring_index(value, "|", 1), F.substring_index(value, "|", -1)
    script = (F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek").otherwise("latin"))
    n = min(3 + attempt, 15)

    def word(w: Column, at: Column) -> Column:
        i = (at / 2).cast("int")  # words and what separates them take turns
        made = F.lit("")
        for script_name, syllables in SYLLABLES.items():
            table = F.array(*[F.lit(x) for x in syllables])
            each = F.concat(*[F.element_at(table, F.element_at(stream, i * n + k) % len(syllables) + 1) for k in range(1, n + 1)])
            end = F.lit("")
            for g, e in ENDINGS[script_name].items():
                end = F.when(gender == g, e).otherwise(end)
            made = F.when(script == script_name, F.concat(each, F.when(i == 0, end).otherwise(""))).otherwise(made)
        drawn = F.initcap(made)
        return (F.when(w.rlike("^[ -]$") | w.rlike(r"^\p{Ll}+$"), w)
                .when(w.rlike(r"^(?:\p{Lu}\.)+$"), F.regexp_replace(w, F.lit(r"\p{Lu}"), F.substr(drawn, F.lit(1), F.lit(1))))
                .when(w.rlike(r"^\p{Lu}{2,}$"), F.upper(drawn)).otherwise(drawn))

    return F.concat_ws("|", gender, F.array_join(F.transform(F.regexp_extract_all(name, F.lit("[ -]|[^ -]+"), F.lit(0)), word), ""))


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """``kind, value, surrogate`` for distinct ``kind, value``.

    Candidates that collide are drawn again; of entities with the same
    candidate the least value keeps it.  Each attempt is one aggregation and
    two joins of distinct entities, and few entities need a second one.  If
    ``MAX_ATTEMPTS`` are used up (a format of fixed length with hardly more
    values than entities; others grow by a character with each attempt after
    ``OWN_LENGTH``), the rest get their kind and a keyed digest instead: distinct, if not alike.
    """
    entities = stored(entities.distinct(), "entities")
    # a made-up name is nobody's, of whatever gender
    same = F.when(F.col("kind") == "name", F.array(*[F.concat(F.lit(f"{g}|"), F.substring_index("value", "|", -1)) for g in GENDERS]))
    taken = entities.select("kind", F.explode(F.coalesce(same, F.array("value"))).alias("surrogate"))
    done, pending = None, entities
    for attempt in range(MAX_ATTEMPTS):
        drawn = stored(pending.withColumn("surrogate", _candidate(key, attempt)), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        good = stored(first.join(taken, ["kind", "surrogate"], "left_anti"), "good")
        done = good if done is None else done.unionByName(good)
        taken = taken.unionByName(good.select("kind", "surrogate"))
        pending = stored(pending.join(good, ["kind", "value"], "left_anti"), "pending")
        if pending.isEmpty():
            return done.select("kind", "value", "surrogate")
    rest = pending.withColumn("surrogate", F.concat(
        "kind", F.lit("-"), F.sha2(F.concat(F.lit(key), F.sha2(F.concat(F.lit(key), "kind", "value"), 256)), 256)))
    return done.unionByName(rest).select("kind", "value", "surrogate")


def rendered(kind: Column, raw: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the format of one mention: characters of ``surrogate``
    take the places of letters and digits of ``raw``, punctuation stays."""
    plain = F.split(surrogate, "(?!^)")
    places = F.transform(F.split(raw, "(?!^)"), lambda c: ~c.rlike("[ ()./-]"))
    chars = F.split(raw, "(?!^)")
    woven = let(plain, lambda s: let(places, lambda p: F.aggregate(
        F.zip_with(chars, p, lambda c, q: F.struct(c.alias("c"), q.alias("q"))),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("n")),
        lambda a, x: F.struct(F.concat(a["out"], F.when(x["q"], F.coalesce(F.get(s, a["n"]), F.lit(""))).otherwise(x["c"])).alias("out"),
                              (a["n"] + F.when(x["q"], 1).otherwise(0)).alias("n")))["out"]))
    # the title stays; who is named by one word gets the last one
    name = F.substring_index(surrogate, "|", -1)
    name = F.concat(F.regexp_extract(raw, TITLE, 0),
                    F.when(F.regexp_replace(raw, TITLE, "").contains(" "), name).otherwise(F.substring_index(name, " ", -1)))
    return F.when(kind == "name", name).when(kind.isin("card", "ssn", "phone", "iban") & (F.length(surrogate) == F.length(value)), woven).otherwise(surrogate)


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with surrogates in ``text_col``, and
    ``n_entities`` (mentions replaced), renamed if ``docs`` has that name.

    Null and empty texts and texts without an entity stay as they are, with 0.
    Repeated rows are rewritten alike; an empty table gives an empty result.

    Only texts with an entity move.  Their mentions are joined to the table of
    surrogates (a frequent entity is split by Spark's skew join) and gathered
    per distinct text, which its own length bounds.
    """
    spare = "n_entities" if "n_entities" not in docs.columns else "n_entities_replaced"
    text = F.col(text_col)
    has = F.coalesce(may_have(text) & text.rlike(ANY), F.lit(False))
    pack = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text"), has.alias("has"))
    with_any = pack.where("has").select("row", "text", F.md5("text").alias("digest"))
    one = with_any.dropDuplicates(["digest"]).select("digest", "text", F.filter(
        F.regexp_extract_all("text", F.lit(ANY), F.lit(0)), lambda m: m.rlike(TITLE)).alias("titled"))
    one = one.select("digest", "text", people(F.col("titled")).alias("known"))
    found = one.select("digest", "known", F.regexp_extract_all("text", named_by(F.col("known")), F.lit(0)).alias("all"))
    found = found.select("digest", "known", F.posexplode("all").alias("at", "raw")).withColumn("kind", kind_of(F.col("raw")))
    value = F.when(F.col("kind") == "name", who(F.col("raw"), F.col("known"))).otherwise(canonical(F.col("kind"), F.col("raw")))
    found = stored(found.withColumn("value", value), "mentions")
    table = stored(surrogate_table(found.select("kind", "value"), key), "surrogates")
    placed = (found.join(table, ["kind", "value"])
              .select("digest", "at", "known", rendered(F.col("kind"), F.col("raw"), F.col("value"), F.col("surrogate")).alias("new"))
              .groupBy("digest").agg(F.first("known").alias("known"), F.array_sort(F.collect_list(F.struct("at", "new"))).alias("mentions")))
    gaps = F.split("text", named_by(F.col("known")), -1)
    woven = F.array_join(F.flatten(F.zip_with(gaps, F.transform("mentions", lambda m: m["new"]),
                                              lambda g, m: F.array(g, F.coalesce(m, F.lit(""))))), "")
    new = with_any.join(placed, "digest").select("row", woven.alias("new"), F.size("mentions").alias("n"))
    same = pack.where("not has").select("row", F.col("text").alias("new"), F.lit(0).alias("n"))
    columns = [F.col("new").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns]
    return new.unionByName(same).select(*columns, F.col("n").alias(spare))
