"""Personal data replaced by keyed, type-consistent surrogates, with DataFrame functions only.

One regular expression finds the mentions in a text: e-mail addresses, telephone numbers, card numbers, IPv4 addresses, IBANs,
social security numbers, secrets (after ``token =``, ``password:`` and the like, or by their form), and persons after a title.
A mention's canonical form (lower case of an address, digits of a number) and a secret key determine its surrogate, so all
mentions in all documents get the same one (coreference). Digits become digits and letters letters of their case, in the
places where the mention has them; a card number keeps its check digit valid, an address stays valid. A person's given and
family names are entities of their own: a surrogate keeps the title, has its gender and the script of the name, and "Mr. John
Smith", "Herr John Smith" and "Mr. Smith" share their parts. Where a text has such a mention, the same names without a title are
replaced in it too. Not found: persons without any title in the text, and formats that the patterns don't have.

Distinct entities of one type whose surrogates are equal, or equal to an entity that occurs, are given further attempts, in
the order of their canonical forms. Those that find none in ROUNDS (a type whose forms nearly all occur) exchange their own
forms in a cycle, which keeps them distinct; a single one of its form then shares a surrogate. Only entities are shuffled, and
of texts only those that have any.

Null and empty texts stay as they are, an empty table gives an empty result. Texts of any length are searched whole: no
pattern repeats a group without bound. Where two patterns begin at one place, the first in PATTERNS wins. Repeated rows are
replaced alike. Extra columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._scratch import Scratch, parts

ROUNDS = 12
CYCLE = 10_000  #: entities that exchange their forms in one task
_L = r"\p{L}"
_ASSIGNED = r"(?<![A-Za-z])(?:[A-Za-z]{1,20}[_\-])?(?i:token|key|secret|password|passwd|pwd)[\"']?[ \t]{0,2}[:=][ \t]{0,2}[\"']?"
_VALUE = r"[A-Za-z0-9_+/=\-.!@#$%^&*]"
_TITLES = {"m": ["Mr", "Herr", "Monsieur", "Señor", "г-н"], "f": ["Mrs", "Ms", "Frau", "Madame", "Señora", "г-жа"]}
_TITLE = "^(" + "|".join(t for ts in _TITLES.values() for t in ts) + r")(\.?) "
#: type -> pattern without capturing groups; where two begin at one place, the first named wins.
PATTERNS: dict[str, str] = {
    "email": r"(?<![A-Za-z0-9_%+\-.])[A-Za-z0-9_%+\-.]++@(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "secret": rf"{_ASSIGNED}(?:(?={_VALUE}{{0,60}}[0-9]){_VALUE}{{8,}}+|{_VALUE}{{16,}}+)|\bAKIA[A-Z0-9]{{16}}\b|\b[0-9a-f]{{40}}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "card": r"(?<![\d\-])(?:\d{16}|\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}|3[47]\d{13}|3[47]\d{2}[ \-]\d{6}[ \-]\d{5})(?![\d\-])",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"(?<![\d\w])\+\d{1,3}(?:[ .\-]?\(\d{1,4}\)[ .\-]?\d{3,4}[ .\-]\d{4}|(?:-\d{2,4}){2,4}|(?: \d{2,4}){2,4}(?!\.\d)| ?\d{6,12})(?!\d)|(?<![\d\w])\(\d{3}\)[ .\-]?\d{3}[.\-]\d{4}(?!\d)|(?<![\d\w.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])",
    "person": rf"\b(?:Mr|Mrs|Ms|Herr|Frau|Monsieur|Madame|Señor|Señora)\b\.? \p{{Lu}}[{_L}'’\-]+(?: \p{{Lu}}[{_L}'’\-]+)?|г-(?:н|жа) \p{{Lu}}[{_L}\-]+(?: \p{{Lu}}[{_L}\-]+)?",
}
#: What a text must have for any pattern to match; cheap to look for.
HINT = r"[0-9@:=]|\b(?:M(?:rs?|s)|Herr|Frau|Monsieur|Madame|Señora?)\b|г-(?:н|жа) "
_ANY = "|".join(PATTERNS.values())

# Surrogate names: gender and script -> given names; script -> family names.
GIVEN = {
    "m": ["Adam", "Bruno", "Carl", "Daniel", "Emil", "Felix", "Gustav", "Hugo", "Ivan", "Jakob", "Karim", "Leon", "Martin", "Noah", "Oscar", "Paul"],
    "f": ["Anna", "Bella", "Clara", "Diana", "Elena", "Frida", "Greta", "Hanna", "Ines", "Julia", "Karin", "Laura", "Maria", "Nora", "Olga", "Paula"],
    "mc": ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Леонид", "Максим"],
    "fc": ["Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Ксения", "Лидия", "Мария", "Нина"],
}
FAMILY = {
    "l": ["Albrecht", "Bishop", "Carver", "Duval", "Engel", "Fischer", "Garnier", "Holt", "Ibsen", "Jansen", "Keller", "Lambert", "Moreno", "Navarro", "Olsen", "Perrin", "Quint", "Rivera", "Seidel", "Torres"],
    "c": ["Белый", "Волков", "Громов", "Дроздов", "Жуков", "Зимин", "Козлов", "Лебедь", "Морозов", "Орлов"],
}


def _canonical(kind: Column, value: Column) -> Column:
    """What mentions of one entity share."""
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin("card", "ssn", "phone"), F.regexp_replace(value, r"\D", ""))
        .when(kind == "iban", F.replace(value, F.lit(" ")))
        .when(kind == "secret", F.regexp_replace(value, f"^{_ASSIGNED}", ""))
        .otherwise(value)
    )


def _units(kind: Column, value: Column) -> Column:
    """The entities of a mention: itself, or a person's given and family names, with their gender where they show it."""
    words = F.split(F.regexp_replace(value, _TITLE, ""), " ")
    gender = F.when(F.regexp_extract(value, _TITLE, 1).isin(_TITLES["m"]), "m|").otherwise("f|")

    def part(w: Column, i: Column) -> Column:
        family = i == F.size(words) - 1
        sex = F.when(family & ~w.rlike(r"^\p{IsCyrillic}"), "l|").otherwise(gender)
        return F.struct(F.when(family, "family").otherwise("given").alias("kind"), F.concat(sex, w).alias("canonical"), w.alias("word"))

    own = F.struct(kind.alias("kind"), _canonical(kind, value).alias("canonical"), value.alias("word"))
    return F.when(kind == "person", F.transform(words, part)).otherwise(F.array(own))


def _kind(value: Column) -> Column:
    out = F.when(value.rlike(_TITLE), "person").otherwise("secret")
    for name, pattern in reversed(PATTERNS.items()):
        if name not in ("secret", "person"):
            # lookarounds see the value alone here, which only makes them easier to meet
            out = F.when(value.rlike(f"^(?:{pattern})$"), name).otherwise(out)
    return out


def _digest(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    """128 hexadecimal characters that depend on key, entity and attempt: an inner and an outer hash, as in HMAC."""
    inner = F.sha2(F.concat_ws("|", F.lit(key), kind, canonical, attempt.cast("string")), 256)
    return F.concat(F.sha2(F.concat(F.lit(key + "#0"), inner), 256), F.sha2(F.concat(F.lit(key + "#1"), inner), 256))


def _nibbles(digest: Column, i: Column) -> Column:
    """A number below 65,536 for the character i (from 0) of a value."""
    return F.conv(F.substring(digest, (F.pmod(i * 4, F.lit(124)) + 1).cast("int"), F.lit(4)), 16, 10).cast("int")


def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _shaped(value: Column, digest: Column, hexa: Column) -> Column:
    """Each digit another digit, each letter another letter of its case; in hexadecimal values letters a to f."""
    low, up, hx = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
    pick = lambda s, n: F.substring(F.lit(s), F.pmod(n, F.lit(len(s))) + 1, F.lit(1))

    def char(c: Column, i: Column) -> Column:
        n = _nibbles(digest, i) + i * 7
        return F.when(hexa & c.rlike("[0-9a-f]"), pick(hx, n)).when(c.rlike("[0-9]"), pick("0123456789", n)).when(c.rlike("[a-z]"), pick(low, n)).when(c.rlike("[A-Z]"), pick(up, n)).otherwise(c)

    return F.array_join(F.transform(_chars(value), char), "")


def _luhn(digits: Column) -> Column:
    """The sum that a valid card number has at 0 modulo 10."""
    d = F.transform(_chars(digits), lambda c, i: F.when((F.length(digits) - i) % 2 == 0, c.try_cast("int") * 2 - F.when(c.try_cast("int") > 4, 9).otherwise(0)).otherwise(c.try_cast("int")))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x)


def _surrogate(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    """The canonical form of the surrogate."""
    digest = _digest(key, kind, canonical, attempt)
    shaped = _shaped(canonical, digest, (kind == "secret") & canonical.rlike("^[0-9a-f]+$"))
    octet = lambda i: (F.pmod(_nibbles(digest, F.lit(i)), F.lit(254)) + 1).cast("string")
    private = F.regexp_extract(canonical, r"^(10\.|192\.168\.|127\.)", 1)
    ip = F.when(private == "192.168.", F.concat(private, F.concat_ws(".", octet(2), octet(3)))).when(private != "", F.concat(private, F.concat_ws(".", octet(1), octet(2), octet(3)))).otherwise(
        F.concat_ws(".", (F.pmod(_nibbles(digest, F.lit(0)), F.lit(113)) + 11 + F.when(F.pmod(_nibbles(digest, F.lit(7)), F.lit(2)) == 0, 117).otherwise(0)).cast("string").substr(1, 3), octet(1), octet(2), octet(3))
    )
    head = F.concat(F.substring(canonical, 1, 2), F.substring(shaped, F.lit(3), F.length(canonical) - 3))
    valid = _luhn(canonical) % 10 == 0
    check = F.pmod(-_luhn(F.concat(head, F.lit("0"))), F.lit(10))
    card = F.concat(head, F.when(valid, check).otherwise(F.pmod(check + 1 + F.pmod(_nibbles(digest, F.lit(20)), F.lit(9)), F.lit(10))).cast("string"))
    local, domain = F.regexp_extract(canonical, "^([^@]+)@", 1), F.regexp_extract(canonical, "@(.+)$", 1)
    tld = F.regexp_extract(domain, r"(\.[a-z]+)$", 1)
    own = F.when(attempt >= 4, F.substring(digest, 1, 6)).otherwise("")  # short forms have few surrogates
    email = F.concat(_shaped(local, digest, F.lit(False)), own, F.lit("@"), _shaped(F.regexp_replace(domain, r"\.[a-z]+$", ""), F.sha2(F.concat(F.lit(key), domain), 512), F.lit(False)), tld)
    phone = F.concat(F.substring(canonical, 1, 1), F.substring(shaped, F.lit(2), F.length(canonical)))
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone)
        .when(kind == "iban", F.concat(F.substring(canonical, 1, 2), F.substring(shaped, F.lit(3), F.length(canonical))))
        .when(kind.isin("given", "family"), _name(kind, canonical, digest, attempt)).when((kind == "secret") & (attempt >= 4), F.substring(F.repeat(digest, 8), F.lit(1), F.length(canonical))).otherwise(shaped)
    )


def _name(kind: Column, canonical: Column, digest: Column, attempt: Column) -> Column:
    sex, name = F.substring(canonical, 1, 1), F.substring(canonical, F.lit(3), F.length(canonical))
    cyrillic, female = name.rlike(r"^\p{IsCyrillic}"), sex == "f"
    pick = lambda names, i: F.element_at(F.array(*map(F.lit, names)), F.pmod(_nibbles(digest, F.lit(i)), F.lit(len(names))) + 1)
    given = lambda i: F.when(cyrillic & female, pick(GIVEN["fc"], i)).when(cyrillic, pick(GIVEN["mc"], i)).when(female, pick(GIVEN["f"], i)).otherwise(pick(GIVEN["m"], i))
    family = lambda i: F.when(cyrillic, pick(FAMILY["c"], i)).otherwise(pick(FAMILY["l"], i))
    # further attempts draw from a larger set: a second name, then one with a syllable of its own
    more = lambda f: F.when(attempt >= 1, F.concat(F.lit("-"), f(3))).otherwise("")
    own = F.when(attempt >= 2, F.when(cyrillic, F.translate(F.substring(digest, 1, 6), "0123456789abcdef", "абвгдежиклмнопрс")).otherwise(F.translate(F.substring(digest, 1, 6), "0123456789abcdef", "abcdefghiklmnoprs"[:16]))).otherwise("")
    ending = F.when(cyrillic & female & ~family(2).rlike("[йь]$"), "а").otherwise("")
    return F.concat(sex, F.lit("|"), F.when(kind == "given", F.concat(given(1), more(given), own)).otherwise(F.concat(family(2), more(family), own, ending)))


def _filled(value: Column, surrogate: Column, place: str) -> Column:
    """``value`` with the surrogate's characters, one by one, in those places that match."""
    return F.aggregate(
        _chars(value), F.struct(F.lit("").alias("out"), F.lit(1).alias("i")),
        lambda a, c: F.struct(F.concat(a["out"], F.when(c.rlike(place), F.substring(surrogate, a["i"], F.lit(1))).otherwise(c)).alias("out"), (a["i"] + F.when(c.rlike(place), 1).otherwise(0)).alias("i")),
        lambda a: a["out"],
    )


def _rendered(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the format of a mention."""
    upper = F.when((value == F.upper(value)) & (value != F.lower(value)), F.upper(surrogate)).otherwise(surrogate)
    return (
        F.when(kind.isin("card", "ssn", "phone"), _filled(value, surrogate, "[0-9]")).when(kind == "iban", _filled(value, surrogate, "[^ ]"))
        .when(kind == "email", upper).when(kind == "secret", F.concat(F.regexp_extract(value, f"^{_ASSIGNED}", 0), surrogate))
        .when(kind.isin("given", "family"), F.substring(surrogate, F.lit(3), F.length(surrogate))).otherwise(surrogate)
    )


#: Marks mentions and bare names in a text; the mark itself is escaped first.
_ESC, _CUT, _BARE = "\u0001e", "\u0001s", "\u0001b"


def _segments(text: Column) -> Column:
    """The text cut at its entities: what stands at odd places (from 0) is one."""
    marked = F.regexp_replace(F.replace(text, F.lit("\u0001"), F.lit(_ESC)), f"({_ANY})", f"{_CUT}$1{_CUT}")
    return F.split(marked, _CUT)


def _odd(segments: Column) -> Column:
    return F.filter(segments, lambda _, i: i % 2 == 1)


def _form(kind: Column, canonical: Column) -> Column:
    """What two entities that exchange their forms must share."""
    same = F.when(kind == "iban", F.substring(canonical, 1, 2)).when(kind == "card", (_luhn(canonical) % 10 == 0).cast("string")).when(kind == "ip", F.regexp_extract(canonical, r"^(10\.|192\.168\.|127\.)", 1)).otherwise("")
    return F.concat_ws("|", kind, F.when(kind == "ip", 0).otherwise(F.length(canonical)), same)


def assign(entities: DataFrame, key: str, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """entities: distinct (kind, canonical). Adds attempt and surrogate, distinct within a kind and no entity's own form."""
    known = entities.select("kind", "canonical")
    now = scratch.table(known.withColumn("attempt", F.lit(0)).withColumn("surrogate", _surrogate(key, F.col("kind"), F.col("canonical"), F.lit(0))))
    for attempt in range(1, rounds + 2):
        holder = now.groupBy("kind", "surrogate").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("attempt", "canonical")).alias("first")).where("n > 1")
        clash = now.join(holder, ["kind", "surrogate"]).where("struct(attempt, canonical) <> first").select("kind", "canonical")
        taken = now.join(known.select("kind", F.col("canonical").alias("surrogate")), ["kind", "surrogate"], "left_semi").select("kind", "canonical")
        bad = scratch.table(clash.union(taken).distinct())
        if bad.isEmpty():
            return now
        if attempt <= rounds:
            again = bad.withColumn("attempt", F.lit(attempt)).withColumn("surrogate", _surrogate(key, F.col("kind"), F.col("canonical"), F.lit(attempt)))
        else:
            # no surrogate that was given is an entity's own form, so those of the rest are free for each other
            order = _digest(key, F.col("kind"), F.col("canonical"), F.lit(-1))
            groups = max(1, bad.count() // CYCLE)
            left = bad.withColumn("_o", order).withColumn("_f", _form(F.col("kind"), F.col("canonical"))).withColumn("_g", F.pmod(F.xxhash64("_o"), F.lit(groups)))
            w = Window.partitionBy("_f", "_g").orderBy("_o", "canonical")
            whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            following = F.coalesce(F.lead("canonical").over(w), F.first("canonical").over(whole))
            left = left.withColumn("_next", following)
            again = left.select("kind", "canonical", F.lit(attempt).alias("attempt"), F.when(F.col("_next") != F.col("canonical"), F.col("_next")).otherwise(_surrogate(key, F.col("kind"), F.col("canonical"), F.lit(attempt))).alias("surrogate"))
        new = scratch.table(now.join(bad, ["kind", "canonical"], "left_anti").unionByName(again))
        scratch.drop(now, bad)
        now = new
    return now


def replace_entities(docs: DataFrame, key: str = "millrace", text: str = "text", length: str | None = "n_chars", count: str | None = None) -> DataFrame:
    """``docs`` with every mention replaced; ``length`` is set anew where it is a column; ``count`` names a column to add that
    holds how many mentions were replaced, per type, as a map (bare names are not counted)."""
    scratch = Scratch(docs.sparkSession)
    names = docs.columns
    own = docs.select(F.struct(F.lit(0).alias("_"), *[docs[c] for c in names if c != text]).alias("_row"), docs[text].alias("_text"))
    # the texts are searched once: the table holds all of them, cut at their mentions
    seg = F.when(F.col("_text").rlike(HINT), _segments(F.col("_text"))).otherwise(F.array(F.replace("_text", F.lit("\u0001"), F.lit(_ESC))))
    cut = own.select("_row", F.when(F.col("_text").isNotNull(), seg).alias("_seg"))
    cut = scratch.table(cut.withColumn("_sha", F.when(F.size("_seg") > 1, F.sha2(F.array_join("_seg", _CUT), 256))))
    found = cut.where("_sha is not null")
    mentions = found.select("_sha", F.explode(F.array_distinct(_odd(F.col("_seg")))).alias("value")).distinct().withColumn("kind", _kind(F.col("value")))
    units = scratch.table(mentions.select("_sha", "value", F.col("kind").alias("of"), F.posexplode(_units(F.col("kind"), F.col("value"))).alias("place", "u")).select("_sha", "value", "of", "place", "u.*"))
    # dealt out by number: surrogates cost more time than their few bytes tell Spark
    entities = units.select("kind", "canonical").distinct().repartition(parts(docs.sparkSession), "kind", "canonical")
    given = assign(entities, key, scratch)
    told = units.join(given, ["kind", "canonical"]).select("_sha", "value", "of", "place", "word", _rendered(F.col("kind"), F.col("word"), F.col("surrogate")).alias("new"))
    told = told.groupBy("_sha", "value", "of").agg(F.array_sort(F.collect_list(F.struct("place", "word", "new"))).alias("parts"))
    person = F.col("of") == "person"
    new = F.when(person, F.concat(F.regexp_extract("value", _TITLE, 0), F.array_join("parts.new", " "))).otherwise(F.col("parts")[0]["new"])
    told = told.groupBy("_sha").agg(
        F.map_from_entries(F.collect_list(F.struct("value", F.struct(new.alias("new"), F.col("of").alias("kind"))))).alias("_new"),
        F.array_sort(F.flatten(F.collect_list(F.when(person, F.transform("parts", lambda x: F.struct(F.length(x["word"]).alias("n"), x["word"].alias("word"), x["new"].alias("new"))))))).alias("_names"),
    )
    joined = found.join(told, "_sha")
    # names without a title, in texts that have them with one: the longer first, of equal ones the first
    bare = F.reverse(F.array_distinct(F.transform("_names", lambda x: x["word"])))
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(F.transform(bare, lambda w: F.concat(F.lit(r"\Q"), w, F.lit(r"\E"))), "|"), F.lit(r")(?!\p{L})"))
    joined = joined.withColumn("_bare", F.when(F.size("_names") > 0, pattern))

    def unnamed(s: Column) -> Column:
        pieces = F.split(F.regexp_replace(s, F.col("_bare"), F.lit(f"{_BARE}$0{_BARE}")), _BARE)
        return F.array_join(F.transform(pieces, lambda x, j: F.when(j % 2 == 1, F.filter("_names", lambda y: y["word"] == x)[0]["new"]).otherwise(x)), "")

    pieces = F.transform("_seg", lambda s, i: F.when(i % 2 == 1, F.element_at(F.col("_new"), s)["new"]).when(F.col("_bare").isNotNull(), unnamed(s)).otherwise(s))
    plain = lambda segments: F.replace(F.array_join(segments, ""), F.lit(_ESC), F.lit("\u0001"))
    kinds = F.transform(_odd(F.col("_seg")), lambda s: F.element_at(F.col("_new"), s)["kind"])
    counts = F.map_from_entries(F.transform(F.array_sort(F.array_distinct(kinds)), lambda k: F.struct(k, F.size(F.filter(kinds, lambda x: x == k)))))
    changed = joined.select("_row", plain(pieces).alias("_whole"), counts.alias("_n"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    same = cut.where("_sha is null").select("_row", plain(F.col("_seg")).alias("_whole"), none.alias("_n"))
    both = changed.union(same)
    out = [F.col("_whole").alias(c) if c == text else F.when(F.col("_whole").isNull(), F.col("_row")[c]).otherwise(F.length("_whole").cast(docs.schema[c].dataType)).alias(c) if c == length else F.col("_row")[c].alias(c) for c in names]
    return both.select(*out, *([F.col("_n").alias(count)] if count else []))
