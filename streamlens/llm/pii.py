"""Surrogates for personal data, in DataFrame functions only.

Detected entities (e-mail, phone, payment card, social security number, IBAN,
IP address, secrets, titled person names) are replaced by surrogates of the same
type: digits by digits, small and capital letters by their like, separators and
length kept; cards keep a valid check digit, IBANs their country and a valid
checksum, names their script, and given names the gender of the title.

A surrogate follows from a secret key and the entity's normal form, so every
mention of an entity in any spelling gets the same one (coreference).  An
entity is made of parts: the host of an e-mail address and the surname of a
person are replaced alike wherever they recur.

Persons are found after a title (of TITLES, with academic titles behind it).
The surrogate of a given name has the gender of the title; after a neutral title
that which most mentions of the same full name have in the corpus.  Every other
capitalised word of the same document that is one of its names is replaced as
well: "Smith agreed", "John Smith's".  Titles, initials and particles ("J.",
"van") stay.

Look-alikes are kept: card numbers need the length and first digits of an
issuer and a Luhn sum of zero, IBANs a remainder of one modulo 97, the value of
a secret after a plain colon ("The secret: ...") a digit or a mark.  Of a number
with a group too many ("4111 1111 1111 1111 123") the valid first part counts.

Distinctness: the distinct parts of the corpus are assigned in rounds.  A part
keeps its candidate if no other part has it or had it before and it is not
itself a part that occurs; the others draw again.  So different parts never
share a surrogate, and no surrogate is a detected value of the corpus.  Rounds
go on until every part has one.  After ``SAME_LENGTH`` rounds a format is taken
as used up and candidates get one character longer each round (IP addresses turn
into keyed IPv6 addresses of 2001:db8::/32, secrets into keyed letters and
digits), so a corpus that holds most values of a short format ends as well.  A
secret without a letter or digit is drawn that way from the first round, since
there is nothing in it to be masked.

A cheap test picks the texts that can hold an entity; their mentions are
extracted once and written with the row.  Only texts with entities are shuffled.
A part or a list of entities that holds a third of all mentions is one row of the
assignment; the joins back have one unique side and are split by AQE.

Limits: a name that has no title anywhere in its document is not found; a person
has at most MAX_NAMES names.  Not found either are numbers written with other
separators than the patterns have, and IPv6 addresses.

Edge cases: NULL and empty texts and texts without entities are unchanged.
NULLs in other columns, extra columns and repeated rows are kept as they are.
An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.llm.common import materialize, own_exchange, set_aside

SAME_LENGTH = 4  # rounds
DRAWS_PER_TASK = 5000

# Titles that introduce a person, by gender (fixed values)
TITLES = {
    "m": ["Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Don", "господин", "Господин", "κύριος", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mademoiselle", "Mme", "Señora", "Señorita", "Doña",
          "госпожа", "Госпожа", "κυρία", "Κυρία"],
    "u": ["Dr", "Prof", "Professor"],
}
SYLLABLES = {
    "latin": "ba be bi bo da de do fa fe ga go ha he ja ka ke ko la le li lo ma me mi mo na ne ni no pa pe "
             "ra re ri ro sa se si so ta te ti to va ve vi za".split(),
    "cyrillic": "ба бе би бо ва ве ви га го да де ди до за зи ка ки ко ла ле ли ло ма ме ми мо на не ни но "
                "па пе ра ре ри ро са се си та те ти то".split(),
    "greek": "βα βε γα γε δα δε ζα θα θε κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο πα πε ρα ρε ρι ρο "
             "σα σε τα τε τι το φα".split(),
}
ENDINGS = {"latin": {"m": "n", "f": "na", "u": "l"}, "cyrillic": {"m": "н", "f": "на", "u": "к"},
           "greek": {"m": "ς", "f": "να", "u": "ν"}}

MAX_NAMES = 8  # names of a person after the title
PARTICLES = "van von de der den del della di da do dos du la le ter ten zu bin ibn al el y".split()

# a possessive "'s" is no part of a name
_NAME = r"\p{Lu}(?=[\p{L}\p{M}]|['’\-]\p{L})[\p{L}\p{M}]*+(?:['’\-](?![sS](?!\p{L}))[\p{L}\p{M}]++){0,4}"
_TITLE = "|".join(t for g in TITLES.values() for t in g)
_PARTICLE = "|".join(PARTICLES)
_INITIALS = r"(?:\p{Lu}\.){1,3}"
_NEXT = rf"(?:{_INITIALS} ){{0,3}}(?:(?:{_PARTICLE}) ){{0,3}}{_NAME}"
# what comes before the value of a secret: the end of a name, perhaps quoted, and an assignment
_KEYWORD = r"(?i:password|passwd|pwd|passphrase|token|secret|(?:api|access|secret|private)[_\-]?key)"
_SECRET = _KEYWORD + r"[\"']?[ \t]{0,3}(?::=|=>|[:=])[ \t]{0,3}[\"']?"
# an assignment in code has a quote or an equals sign; after a plain colon the value shows that it is one
_CODE = (_KEYWORD + r"(?:[\"'][ \t]{0,3}(?::=|=>|[:=])[ \t]{0,3}[\"']?"
         r"|[ \t]{0,3}(?:(?::=|=>|=)[ \t]{0,3}[\"']?|:[ \t]{0,3}[\"']))")
_PROSE = _KEYWORD + r"[ \t]{0,3}:[ \t]{0,3}(?=[^\s\"']*?(?:\p{N}|[^\p{L}\p{M}\s\"'’.,;:!?()\-…])|[^\p{L}\s\"']{6})"
# kind -> pattern of a whole entity, tried in this order
KINDS = {
    "email": r"[\p{L}\p{N}_][\p{L}\p{M}\p{N}._%+\-]{0,63}@(?:[\p{L}\p{M}\p{N}\-]{1,63}\.){1,8}(?:[A-Za-z]{2,24}|\p{L}{2,24})",
    "secret": rf"(?:{_CODE}|{_PROSE})" + r"[^\s\"']{6,}",
    "keyid": r"(?:AKIA|ASIA)[0-9A-Z]{12,20}(?![0-9A-Za-z])|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9\-]{20,}",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ip": r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![0-9A-Za-z]|\.\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?![0-9A-Za-z]|-\d)",
    "card": "(?:[2-6]\\d{12,18}|" + "|".join(
        rf"[2-6]\d{{3}}(?:{s}\d{{4}}){{2}}{s}\d{{1,4}}(?:{s}\d{{3}})?|3\d{{3}}{s}\d{{6}}{s}\d{{4,5}}" for s in " -")
            + ")(?![0-9A-Za-z])",
    "phone": r"\+\d{1,3}[ .\-]?(?:\(\d{1,5}\)[ .\-]?)?\d{2,5}(?:[ .\-]?\d{2,5}){1,4}(?![0-9A-Za-z])"
             r"|\(\d{3}\) ?\d{3}[ .\-]\d{4}(?![0-9A-Za-z])|\d{3}[.\-]\d{3}[.\-]\d{4}(?![0-9A-Za-z]|-\d)",
    "person": rf"(?:{_TITLE})\.? (?:(?:{'|'.join(TITLES['u'])})\.? ){{0,2}}{_NEXT}(?: {_NEXT}){{0,{MAX_NAMES - 1}}}",
}
# first digits and length of the card issuers (fixed values)
ISSUERS = (r"^(?:4(?:\d{12}|\d{15}|\d{18})|5[1-5]\d{14}|2[2-7]\d{14}|3[47]\d{13}|3[0689]\d{12}|35\d{14,17}"
           r"|(?:5[0678]|6\d)\d{11,17})$")
_START = r"(?<![\p{L}\p{N}_])"
# a secret's name may have anything before it: DB_PASSWORD, client_secret, accessToken
PATTERN = "(?:" + _START + "(?:" + "|".join(p for k, p in KINDS.items() if k != "secret") + ")|" + KINDS["secret"] + ")"
# what every text with an entity holds, in patterns that are cheap to try
HINTS = [r"[0-9][0-9 .()\-]{5,}[0-9]|[A-Z]{2}[0-9]{2}|\+[0-9]",
         rf"(?=[pPtTsSaA]){_SECRET}|AKIA|ASIA|gh[pousr]_|sk-", rf"{_START}(?:{_TITLE})\.? "]
BARE_NAME = _START + _NAME + r"(?![\p{L}\p{N}_])"
_DIGITS, _SMALL, _LARGE, _HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
_KEYED = _SMALL + _DIGITS


def _mentions(text: Column) -> Column:
    """All that looks like an entity, in order; empty for NULL."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), F.array().cast("array<string>"))


def is_entity(mention: Column) -> Column:
    return F.exists(parts(mention), lambda p: p["kind"].isNotNull())


def entities(text: Column) -> Column:
    """All entity mentions of a text in order; empty for NULL.  Untitled
    repeats of a person's name are not among them."""
    return F.filter(_mentions(text), is_entity)


def _may_hold(text: Column) -> Column:
    """False only for texts without an entity."""
    return F.coalesce(reduce(Column.__or__, [text.contains("@")] + [text.rlike(h) for h in HINTS]), F.lit(False))


# ---- mentions as parts -----------------------------------------------------

def _part(kind: Column | str, text: Column, normal: Column | None = None, full: Column | None = None) -> Column:
    """A part: kind NULL is kept as it is; ``full`` is the full name that a given name belongs to."""
    k = F.lit(kind).cast("string") if not isinstance(kind, Column) else kind
    return F.struct(k.alias("kind"), text.alias("text"), (text if normal is None else normal).alias("normal"),
                    (F.lit(None).cast("string") if full is None else full).alias("full"))


def script_of(name: Column) -> Column:
    return (F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek")
            .otherwise("latin"))


def _person(mention: Column) -> Column:
    words = F.split(mention, " ")
    plain = lambda w: F.regexp_replace(w, r"\.$", "")
    title = plain(F.element_at(words, 1))
    gender = F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f").otherwise("u")
    rest = F.slice(words, 2, F.size(words))
    is_name = lambda w: ~(plain(w).isin(TITLES["u"]) | w.isin(PARTICLES) | w.rlike(f"^{_INITIALS}$"))
    full = F.array_join(F.transform(F.filter(rest, is_name), F.lower), " ")
    names = F.transform(rest, lambda w, i: F.array(
        _part(None, F.lit(" ")),
        F.when(~is_name(w), _part(None, w))
        .when(i == F.size(rest) - 1, _part(F.concat(F.lit("surname_"), script_of(w)), w, F.lower(w)))
        .otherwise(_part(F.concat_ws("_", F.lit("given"), gender, script_of(w)), w, F.lower(w), full))))
    return F.concat(F.array(_part(None, F.element_at(words, 1))), F.flatten(names))


def _first(valid: Column, mention: Column, kind: str, normal: Column) -> Column:
    """The entity ``valid`` that a mention begins with, and what follows it; NULL: all is kept."""
    return (F.when(valid.isNull(), F.array(_part(None, mention)))
            .when(valid == mention, F.array(_part(kind, mention, normal)))
            .otherwise(F.array(_part(kind, valid, normal), _part(None, F.substr(mention, F.length(valid) + 1)))))


def _longest_valid(mention: Column, is_valid) -> Column:
    """The longest beginning of whole groups that is valid, or NULL."""
    groups = F.regexp_extract_all(mention, F.lit(r"[ \-]?[^ \-]+"), F.lit(0))
    heads = F.transform(groups, lambda _, i: F.array_join(F.slice(groups, F.lit(1), i + 1), ""))
    valid = F.filter(heads, is_valid)
    return F.when(F.size(valid) > 0, F.element_at(valid, -1))


def parts(mention: Column) -> Column:
    """The parts of a mention, in order; their texts join to the mention."""
    only_digits = lambda s: F.regexp_replace(s, r"[^0-9]", "")
    solid = lambda s: F.regexp_replace(s, " ", "")
    digits = only_digits(mention)
    card = _longest_valid(mention, lambda s: only_digits(s).rlike(ISSUERS) & (_luhn(only_digits(s)) == 0))
    iban = _longest_valid(mention, lambda s: F.length(solid(s)).between(15, 34) & (_iban_sum(solid(s)) == 1))
    host = F.regexp_extract(mention, "@(.*)$", 1)
    head = F.regexp_extract(mention, f"^({_SECRET})", 1)
    value = F.substr(mention, F.length(head) + 1)
    prefix = F.regexp_extract(mention, r"^(AKIA|ASIA|gh[pousr]_|sk-)", 1)
    is_ = {k: mention.rlike(f"^(?:{p})$") for k, p in KINDS.items()}
    secret = F.when(value.rlike("^[0-9a-f]+$"), "secret_hex").otherwise("secret")
    return (F.when(is_["email"], F.array(
                _part("mailbox", F.regexp_extract(mention, "^([^@]*)@", 1), F.lower(mention)),
                _part(None, F.lit("@")), _part("host", host, F.lower(host))))
            .when(is_["secret"], F.array(_part(None, head), _part(secret, value)))
            .when(is_["keyid"], F.array(_part(None, prefix), _part("secret", F.substr(mention, F.length(prefix) + 1))))
            .when(is_["iban"], _first(iban, mention, "iban", solid(iban)))
            .when(is_["ip"], F.array(_part("ip", mention)))
            .when(is_["ssn"], F.array(_part("ssn", mention, digits)))
            .when(is_["card"], _first(card, mention, "card", only_digits(card)))
            .when(is_["phone"], F.array(_part("phone", mention, F.concat(
                F.when(mention.startswith("+"), "+").otherwise(""), digits))))
            .when(is_["person"], _person(mention))
            .otherwise(F.array(_part("name", mention, F.lower(mention)))))


# ---- candidates ------------------------------------------------------------

def _chars(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0))


def _bytes(seed: Column, n: Column) -> Column:
    """At least n pseudo-random bytes as ints."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(n / 32).cast("int")),
                         lambda b: F.sha2(F.concat_ws("|", seed, b.cast("string")).cast("binary"), 256))
    return F.transform(F.regexp_extract_all(F.array_join(blocks, ""), F.lit(".."), F.lit(0)),
                       lambda h: F.conv(h, 16, 10).cast("int"))


def _pick(alphabet: str, v: Column) -> Column:
    return F.substr(F.lit(alphabet), v % len(alphabet) + 1, F.lit(1))


def _masked(s: Column, rnd: Column) -> Column:
    """Every digit and letter replaced by its like, those of other scripts by
    ASCII digits and small or capital ASCII letters; all else kept."""
    def one(c: Column, i: Column) -> Column:
        v = F.get(rnd, i)
        return (F.when(c.rlike(r"\p{N}"), _pick(_DIGITS, v)).when(c.rlike(r"\p{Lu}"), _pick(_LARGE, v))
                .when(c.rlike(r"\p{L}"), _pick(_SMALL, v)).otherwise(c))
    return F.array_join(F.transform(_chars(s), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of all digits, the last counted once."""
    rev = F.reverse(_chars(digits))
    each = F.transform(rev, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10


def _iban_sum(iban: Column) -> Column:
    """ISO 7064 remainder modulo 97 of the rearranged IBAN."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    return F.aggregate(_chars(moved), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _name(kind: Column, rnd: Column, attempt: Column) -> Column:
    n = F.lit(2) + F.get(rnd, F.lit(30)) % 2 + F.floor(attempt / 2).cast("int")  # longer if names run out
    out = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        pool = F.array(*[F.lit(s) for s in syllables])
        stem = F.array_join(F.transform(F.slice(rnd, F.lit(1), F.least(n, F.lit(24))),
                                        lambda v: F.get(pool, v % len(syllables))), "")
        for gender, end in ENDINGS[script].items():
            out = F.when(kind == f"given_{gender}_{script}", F.concat(stem, F.lit(end))).otherwise(out)
        out = F.when(kind == f"surname_{script}", stem).otherwise(out)
    return out


def candidate(kind: Column, normal: Column, attempt: Column, key: str) -> Column:
    """The surrogate that a part draws in a round, in normal form."""
    more = F.greatest(attempt - (SAME_LENGTH - 1), F.lit(0))  # for formats that run out
    rnd = _bytes(F.concat_ws("|", F.lit(key), kind, normal, attempt.cast("string")), F.length(normal) + more + 31)
    longer = F.repeat(F.lit("x"), more)
    masked = _masked(F.concat(normal, F.repeat(F.lit("0"), more)), rnd)
    mailbox = F.regexp_extract(normal, "^([^@]*)@", 1)
    host = F.concat(_masked(F.concat(F.regexp_replace(normal, r"\.[^.]*$", ""), longer), rnd), F.lit(".example"))
    card = F.concat(F.substr(normal, F.lit(1), F.lit(1)), F.substr(masked, F.lit(2)))
    stem = F.substr(card, F.lit(1), F.length(card) - 1)
    valid = F.concat(stem, F.pmod(10 - _luhn(F.concat(stem, F.lit("0"))), F.lit(10)).cast("string"))
    iban = F.concat(F.substr(normal, F.lit(1), F.lit(2)), F.lit("00"), F.substr(masked, F.lit(5)))
    check = F.lpad((98 - _iban_sum(iban)).cast("string"), 2, "0")
    country = F.length(F.regexp_extract(normal, r"^(\+[17]|\+\d\d|0?)", 1))
    ip = F.concat_ws(".", (F.get(rnd, F.lit(0)) % 223 + 1).cast("string"),
                     *[F.get(rnd, F.lit(i)).cast("string") for i in (1, 2, 3)])
    ipv6 = F.concat_ws(":", F.lit("2001:db8"), *[F.lower(F.lpad(F.hex(F.get(rnd, F.lit(i)) * 256 + F.get(rnd, F.lit(i + 1))), 4, "0"))
                                                 for i in range(0, 12, 2)])
    drawn = F.slice(rnd, F.lit(1), F.length(normal) + more)
    hexed = F.array_join(F.transform(drawn, lambda v: _pick(_HEX, v)), "")
    keyed = F.array_join(F.transform(drawn, lambda v: _pick(_KEYED, v)), "")
    return (F.when(kind == "mailbox", _masked(F.concat(mailbox, longer), rnd))
            .when(kind == "host", host)
            .when(kind == "card", F.when(_luhn(normal) == 0, valid).otherwise(card))
            .when(kind == "ssn", F.concat(F.lit("9"), F.substr(masked, F.lit(2))))
            .when(kind == "phone", F.concat(F.substr(normal, F.lit(1), country), F.substr(masked, country + 1)))
            .when(kind == "ip", F.when(more > 0, ipv6).otherwise(ip))
            .when(kind == "iban", F.concat(F.substr(iban, F.lit(1), F.lit(2)), check, F.substr(iban, F.lit(5))))
            .when(kind == "secret_hex", hexed)
            .when(kind == "secret", F.when((more == 0) & normal.rlike(r"[\p{N}\p{L}]"), masked).otherwise(keyed))
            .otherwise(_name(kind, rnd, attempt)))


def assign(found: DataFrame, key: str) -> DataFrame:
    """(kind, normal, surrogate) for the distinct (kind, normal) rows, all
    surrogates of a kind different from each other and from every normal form.

    It ends for every corpus: candidates outgrow the normal forms and the
    surrogates taken before, and each surrogate that is free has one winner."""
    taken: list[DataFrame] = []
    pending = found.select("kind", "normal")
    # drawing is much work for few bytes: spread it by the number of rows
    tasks = max(1, -(-found.count() // DRAWS_PER_TASK))
    for attempt in count():
        drawn = pending.repartition(tasks, "kind", "normal").withColumn("surrogate", candidate(F.col("kind"), F.col("normal"), F.lit(attempt), key))
        real = found.select("kind", F.col("normal").alias("surrogate"))
        free = drawn.join(real, ["kind", "surrogate"], "left_anti")
        for t in taken:
            free = free.join(t.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = free.groupBy("kind", "surrogate").agg(F.min("normal").alias("normal"))
        taken.append(materialize(won.select("kind", "normal", "surrogate"), "surrogates"))
        pending = pending.join(taken[-1], ["kind", "normal"], "left_anti")
        if pending.isEmpty():
            return reduce(DataFrame.union, taken)
        pending = materialize(pending, "surrogates-pending")


# ---- replacement -----------------------------------------------------------

def _shaped(kind: Column, text: Column, surrogate: Column) -> Column:
    """A surrogate in the spelling of the mention; what it is longer follows."""
    digits = F.regexp_replace(surrogate, r"[^0-9]", "")
    spelled = F.array_join(F.transform(_chars(text), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substr(digits, F.length(F.regexp_replace(
            F.substr(text, F.lit(1), i + 1), r"[^0-9]", "")), F.lit(1))).otherwise(c)), "")
    spelled = F.concat(spelled, F.substr(digits, F.length(F.regexp_replace(text, r"[^0-9]", "")) + 1))
    groups = F.array_join(F.transform(_chars(text), lambda c, i: F.when(c == " ", c).otherwise(F.substr(
        surrogate, F.length(F.regexp_replace(F.substr(text, F.lit(1), i + 1), " ", "")), F.lit(1)))), "")
    groups = F.concat(groups, F.substr(surrogate, F.length(F.regexp_replace(text, " ", "")) + 1))
    name = F.when((F.length(text) > 1) & (text == F.upper(text)), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return (F.when(kind.isNull(), text).when(kind.isin("card", "ssn", "phone"), spelled)
            .when(kind == "iban", groups).when(kind.rlike("^(given|surname)_"), name)
            .when(kind.isin("mailbox", "host") & (text == F.upper(text)) & text.rlike("[A-Z]"), F.upper(surrogate))
            .otherwise(surrogate))


def _with_names(text: Column, found: Column) -> Column:
    """The mentions of a text and, in order between them, its capitalised words."""
    return F.flatten(F.transform(F.split(text, PATTERN, -1), lambda piece, i: F.concat(
        F.regexp_extract_all(piece, F.lit(BARE_NAME), F.lit(0)), F.slice(found, i + 1, F.lit(1)))))


def _resolve_names(cut: DataFrame) -> DataFrame:
    """Parts with the gender of neutral titles taken from the full name's other
    mentions, and capitalised words as the name of their document that they are
    (kind NULL: none)."""
    open_ = F.coalesce(F.col("kind").rlike("^(given_u_|name$)"), F.lit(False))
    if cut.where(open_).isEmpty():
        return cut
    cols = cut.columns
    gender = F.substring("kind", 7, 1)
    known = (cut.where("kind rlike '^given_[mf]_'").groupBy("full", gender.alias("gender")).count()
             .groupBy("full").agg(F.max_by("gender", F.struct("count", "gender")).alias("gender")))
    neutral = (cut.where("kind like 'given_u_%'").join(own_exchange(known, "full"), "full", "left")
               .withColumn("kind", F.concat(F.lit("given_"), F.coalesce("gender", F.lit("u")), F.substring("kind", 8, 99))))
    settled = materialize(cut.where(~open_).unionByName(neutral.select(*cols)), "pii-genders")
    roles = (settled.where("kind rlike '^(given|surname)_'").groupBy("__list", "normal")
             .agg(F.min_by("kind", F.struct("at", "sub")).alias("role")))
    bare = (cut.where("kind = 'name'").join(own_exchange(roles, "__list", "normal"), ["__list", "normal"], "left")
            .withColumn("kind", F.col("role")))
    return settled.unionByName(bare.select(*cols))


def replace_entities(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every entity in the text replaced by its surrogate;
    ``count_col`` adds the number of mentions replaced."""
    if not key:
        raise ValueError("a secret key is needed")
    docs, now, back = set_aside(docs, "__found", "__entity", "__person", "__list", "__new", "__n")
    text_col = now(text_col)
    text = F.col(f"`{text_col}`")
    is_person = lambda m: m.rlike(f"^(?:{KINDS['person']})$")
    # extracted once, written with the row
    marked = (docs.where(_may_hold(text)).withColumn("__found", _mentions(text))
              .withColumn("__entity", F.exists("__found", is_entity))
              .withColumn("__person", F.exists("__found", is_person)))
    marked = materialize(marked, "pii-marked")
    list_key = F.sha2(F.to_json("__found"), 256)  # a mention may hold any separator
    with_any = (marked.where("__entity")
                .withColumn("__found", F.when(F.col("__person"), _with_names(text, F.col("__found"))).otherwise(F.col("__found")))
                .withColumn("__list", list_key))
    # one row per distinct list of mentions, cut into parts
    lists = with_any.select("__list", "__found").dropDuplicates(["__list"])
    cut = (lists.select("__list", F.posexplode("__found").alias("at", "mention"))
           .select("__list", "at", F.posexplode(parts(F.col("mention"))).alias("sub", "part"))
           .select("__list", "at", "sub", "part.*"))
    cut = _resolve_names(materialize(cut, "pii-parts"))
    found = materialize(cut.where("kind is not null").select("kind", "normal").distinct(), "pii-found")
    surrogates = assign(found, key)
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sub", "text"))), lambda s: s["text"]), "")
    # text between parts (every "@" of the corpus) needs no surrogate and stays out of the join
    kept = cut.where("kind is null").withColumn("surrogate", F.lit(None).cast("string"))
    shaped = (cut.where("kind is not null").join(surrogates, ["kind", "normal"]).unionByName(kept)
              .withColumn("text", _shaped(F.col("kind"), F.col("text"), F.col("surrogate")))
              .groupBy("__list", "at").agg(whole.alias("text"), F.max(F.col("kind").isNotNull().cast("int")).alias("is"))
              .groupBy("__list").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))),
                                                 lambda s: s["text"]).alias("__new"),
                                     F.sum("is").cast("int").alias("__n")))
    between = F.split(text, PATTERN, -1)
    between = F.when(F.col("__person"), F.flatten(F.transform(between, lambda s: F.split(s, BARE_NAME, -1)))).otherwise(between)
    replaced = F.array_join(F.transform(between, lambda s, i: F.concat(s, F.coalesce(F.get("__new", i), F.lit("")))), "")
    done = with_any.join(own_exchange(shaped, "__list"), "__list").withColumn(text_col, replaced)
    cols = [F.col(f"`{c}`") for c in docs.columns if c != count_col]
    count_of = lambda n: [n.cast("int").alias(count_col)] if count_col else []
    return back(docs.where(~_may_hold(text)).select(*cols, *count_of(F.lit(0)))
                .union(marked.where("not __entity").select(*cols, *count_of(F.lit(0))))
                .union(done.select(*cols, *count_of(F.col("__n")))))
