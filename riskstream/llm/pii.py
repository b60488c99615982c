"""Surrogates for personal data (operator 10).

DataFrame functions only.  Emails, phone numbers, payment cards, IBANs, US
social security numbers, IPv4 and IPv6 addresses, secrets and titled names are
detected in whole texts and replaced by made-up values of the same type: same
format (digits stay digits, case and punctuation stay; an IPv6 address is
written in full), same script and gender for names, valid check digits for
cards and IBANs, private addresses stay private.  A surrogate is a keyed hash of the
entity's canonical form, so the same entity gets the same surrogate in all
documents and spellings.  Collision checks give a new attempt to an entity
whose surrogate another entity has, or which equals a real entity, until all
are distinct.

Texts without entities are not shuffled.  What is shuffled are distinct
(text digest, mention) pairs, the distinct entities and the texts with
entities; entities are grouped only in distinct form, so one that a third of
all documents hold is one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import table, written

KEY = "riskstream"
MAX_ROUNDS = 50

# Titles with the gender they tell, and name stock by script.
TITLES_M = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Sir", "Lord",
            "Signor", "Senhor"]
TITLES_F = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа",
            "Lady", "Dame", "Mlle", "Mademoiselle", "Señorita", "Srta", "Signora", "Senhora"]
TITLES_N = ["Dr", "Prof", "Doctor", "Professor", "Doktor", "Mx", "Rev", "Доктор", "Профессор"]
TITLES = TITLES_M + TITLES_F + TITLES_N
GIVEN = {
    ("latin", "m"): ["albert", "bernard", "conrad", "edgar", "felix", "gustav", "hugo", "jasper",
                     "leopold", "oscar", "rupert", "victor"],
    ("latin", "f"): ["agatha", "beatrix", "clara", "dorothea", "edith", "flora", "greta", "isolde",
                     "martha", "ottilie", "rosalind", "viola"],
    ("cyrillic", "m"): ["борис", "глеб", "егор", "захар", "игнат", "лев", "макар", "федор"],
    ("cyrillic", "f"): ["алла", "вера", "зоя", "инна", "лидия", "нина", "раиса", "фаина"],
}
SYLLABLES = {
    "latin": ["bal", "cor", "den", "far", "gol", "hem", "jor", "kel", "lam", "mor", "nis", "pol",
              "rud", "sal", "tor", "vel"],
    "cyrillic": ["бал", "вор", "гон", "дар", "жел", "зем", "кор", "лам", "мор", "нев", "пол",
                 "рад", "сол", "тар", "фил", "чер"],
}

OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
IPV4 = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)"
CARD = r"(?<![\d+.])\d(?:[ \-]?\d){12,18}(?!\d|\.\d)"
# Unparenthesised numbers are told from dates, versions and ids by their groups
# and by how many digits they have.
PHONE_PLUS = (r"\+(?:1[ .\-]?(?:\(\d{3}\)|\d{3})[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)"
              r"|(?=(?:[ .\-(]{0,2}\d\)?){8})[1-9](?:(?:[ .\-]?\(\d{1,4}\)[ .\-]?|[ .\-]?)\d){7,14}(?!\d))")
PHONE_GROUPS = r"(?:1(?<pu>[ .\-]))?[2-9]\d\d(?<pg>[ .\-])\d{3}\k<pg>\d{4}(?!\d|[.\-/]\d)"
PHONE_TRUNK = (r"(?!\d\d(?<pd>[ .\-/])\d\d\k<pd>(?:19|20)\d\d(?!\d))(?=0(?:[ .\-/]?\d){8})"
               r"00?[1-9]\d{0,3}(?<pt>[ .\-/])\d{2,8}(?:\k<pt>\d{2,8}){0,5}(?!\d|[.\-/]\d)")
PHONE_OPEN = (r"(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d)"
              r"|(?<=\+\d{1,3}[ .\-])\d{2,4}[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d))")
PHONE = (rf"(?<![\d+])(?:{PHONE_PLUS}|{PHONE_OPEN}"
         rf"|(?<!\d[.\-/ ])(?<![.\-/\p{{L}}])(?:{PHONE_GROUPS}|{PHONE_TRUNK}))")
SSN = r"(?<![\d\-])(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\d\-])"
HEX = "[0-9A-Fa-f]{1,4}"
IPV6 = (r"(?<![\w:.])(?=[0-9A-Fa-f]{0,4}:)(?=[A-Fa-f:]*[0-9])(?:" + "|".join(
    [f"(?:{HEX}:){{7}}{HEX}", *[f"(?:{HEX}:){{1,{7 - k}}}(?::{HEX}){{1,{k}}}" for k in range(1, 7)],
     f":(?::{HEX}){{1,7}}", f"(?:{HEX}:){{1,7}}:"]) + r")(?![\w:]|\.\d)")
#: Length of an IBAN -> its countries.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU"}
IBAN = (r"(?<![A-Za-z0-9])(?=[A-Z]{2}\d\d)(?:" + "|".join(
    rf"(?:{c.replace(' ', '|')})\d\d(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
    + r")(?![A-Za-z0-9])")
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
SECRET = (r"(?<=(?i:token|password|passwd|secret|api_key|apikey)['\"]?\s{0,3}[=:]\s{0,3}['\"]?)"
          r"[A-Za-z0-9+/_\-]{12,}")
TITLE = r"(?:(?:" + "|".join(TITLES) + r")\.? )+"
NAME = rf"(?<![\p{{L}}])(?=\p{{Lu}}){TITLE}\p{{Lu}}[\p{{L}}\-]+(?: \p{{Lu}}[\p{{L}}\-]+)?"
MENTION = "|".join([EMAIL, IBAN, ACCESS_KEY, SECRET, IPV6,
                    rf"(?=[\d+(])(?:{IPV4}|{SSN}|{PHONE}|{CARD})", NAME])
SECRET_WORDS = r"(?i:token|password|passwd|secret|api_?key)"


def may_hold(text: Column) -> Column:
    """False for most texts without a mention, by cheap scans before MENTION."""
    title = reduce(lambda a, b: a | b, [text.contains(t) for t in TITLES])
    secret = (text.contains("=") | text.contains(":")) & text.rlike(SECRET_WORDS)
    return F.coalesce(text.rlike("[0-9@]") | title | secret, F.lit(False))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn_sum(number: Column) -> Column:
    """Luhn sum of a digit string, its last digit counted once."""
    d = F.transform(F.reverse(F.split(number, "")), lambda c: c.cast("int"))
    part = F.transform(d, lambda v, i: F.when(i % 2 == 0, v).otherwise(
        F.when(v > 4, v * 2 - 9).otherwise(v * 2)))
    return F.aggregate(part, F.lit(0), lambda a, v: a + v)


def alnum(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9]", "")


def mod_97(account: Column) -> Column:
    """The IBAN's remainder: the first four characters last, letters as 10 to 35."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).when(
        c.rlike("[A-Z]"), (a * 100 + F.ascii(c) - 55) % 97).otherwise(a))


def mention_type(m: Column) -> Column:
    is_card = digits(m).rlike("^(?:4|5[1-5]|2[2-7]|3[0-9]|6)") & (luhn_sum(digits(m)) % 10 == 0)
    return (F.when(m.contains("@"), "email")
            .when(m.rlike(f"^{ACCESS_KEY}$"), "secret")
            .when(m.rlike(f"^{IPV4}$"), "ip")
            .when(m.rlike(f"^{IPV6}$"), "ipv6")
            .when(m.rlike(f"^{SSN}$"), "ssn")
            .when(m.rlike(f"^{IBAN}$"), F.when(mod_97(alnum(m)) == 1, "iban"))
            .when(m.rlike(rf"^(?:[+(][\d ().\-]+|{PHONE})$"),
                  F.when(F.length(digits(m)).between(7, 15), "phone"))
            .when(m.rlike(r"^\d(?:[ \-]?\d){12,18}$"), F.when(is_card, "card"))
            .when(m.rlike(f"^(?:{NAME})$"), "name")
            .otherwise("secret"))


def canonical(kind: Column, m: Column) -> Column:
    """The form that all spellings of an entity share."""
    nat = F.regexp_replace(digits(m), r"^1(?=\d{10}$)", "")
    titles = F.regexp_extract(m, f"^({TITLE})", 1)
    said = lambda some: titles.rlike(r"(?<!\p{L})(?:" + "|".join(some) + ")[. ]")
    gender = F.when(said(TITLES_F), "f").when(said(TITLES_M), "m").otherwise("n")
    name = F.lower(F.regexp_replace(m, f"^{TITLE}", ""))
    sides = F.split(F.lower(m), "::", -1)
    groups = lambda side: F.filter(F.split(side, ":"), lambda g: g != "")
    left, right = groups(sides[0]), groups(F.coalesce(F.get(sides, F.lit(1)), F.lit("")))
    zeros = F.array_repeat(F.lit("0"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0)))
    ipv6 = F.array_join(F.transform(F.concat(left, zeros, right), lambda g: F.lpad(g, 4, "0")), ":")
    return (F.when(kind == "email", F.lower(m)).when(kind == "phone", nat)
            .when(kind.isin("card", "ssn"), digits(m)).when(kind == "iban", alnum(m))
            .when(kind == "ipv6", ipv6).when(kind == "name", F.concat_ws("|", gender, name))
            .otherwise(m))


def hex_stream(key: str, kind: Column, what: Column, attempt: Column, n: Column) -> Column:
    """At least 2n hex digits that depend on the key and the entity."""
    return F.array_join(F.transform(F.sequence(F.lit(0), F.ceil(n / 64).cast("int")), lambda b: F.sha2(
        F.concat_ws("|", F.lit(key), kind, what, attempt.cast("string"), b.cast("string")), 512)), "")


def byte_at(stream: Column, i: Column) -> Column:
    return F.conv(F.substr(stream, 2 * i - 1, F.lit(2)), 16, 10).cast("int")


def pick(choices: list[str], r: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in choices]), r % len(choices) + 1)


def same_format(value: Column, stream: Column) -> Column:
    """Each letter or digit replaced within its class (hex stays hex)."""
    is_hex = value.rlike("^[0-9a-f]+$")

    def one(i: Column) -> Column:
        c, r = F.substr(value, i, F.lit(1)), byte_at(stream, i)
        span = lambda alphabet: F.substr(F.lit(alphabet), r % len(alphabet) + 1, F.lit(1))
        return (F.when(is_hex, span("0123456789abcdef")).when(c.rlike("[0-9]"), span("0123456789"))
                .when(c.rlike("[a-z]"), span("abcdefghijklmnopqrstuvwxyz"))
                .when(c.rlike("[A-Z]"), span("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(c))
    chars = F.transform(F.sequence(F.lit(1), F.greatest(F.length(value), F.lit(1))), one)
    return F.array_join(chars, "")


def surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """The canonical form of an entity's surrogate at this attempt."""
    s = hex_stream(key, kind, canon, attempt, F.length(canon))
    num = same_format(canon, s)
    # Area code and exchange do not begin with 0 or 1.
    lead = lambda i: F.substr(F.lit("23456789"), byte_at(s, F.lit(i)) % 8 + 1, F.lit(1))
    plain_digits = F.regexp_replace(same_format(F.concat(canon, F.lit("z")), s), "[a-z]$", "")
    phone = F.when(canon.startswith("0"), F.concat(  # a trunk zero stays
        F.lit("0"), lead(2), F.substr(plain_digits, F.lit(3), F.length(canon) - 2))).when(
        F.length(canon) == 10, F.concat(
        lead(1), F.substr(plain_digits, F.lit(2), F.lit(2)), lead(4),
        F.substr(plain_digits, F.lit(5), F.lit(6)))).otherwise(
        F.concat(lead(1), F.substr(plain_digits, F.lit(2), F.length(canon))))
    body = F.concat(F.substr(canon, F.lit(1), F.lit(2)),
                    F.substr(plain_digits, F.lit(3), F.length(canon) - 3))
    card = F.concat(body, ((10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))
    # Numbers that can be given out: the area is not 000, 666 or 9xx, no part is 0.
    nonzero = lambda i: F.substr(F.lit("123456789"), byte_at(s, F.lit(i)) % 9 + 1, F.lit(1))
    ssn = F.concat(F.substr(F.lit("1234578"), byte_at(s, F.lit(1)) % 7 + 1, F.lit(1)),
                   F.substr(plain_digits, F.lit(2), F.lit(3)), nonzero(5),
                   F.substr(plain_digits, F.lit(6), F.lit(3)), nonzero(9))
    country = F.substr(canon, F.lit(1), F.lit(2))
    account = F.regexp_replace(F.substr(same_format(F.concat(canon, F.lit("z")), s), F.lit(5)),
                               "[a-z]$", "")
    iban = F.concat(country, F.lpad((98 - mod_97(F.concat(country, F.lit("00"), account))
                                     ).cast("string"), 2, "0"), account)
    special = canon.rlike("^(?:fe[89ab]|f[cdf]|0000:)")
    bits = F.substr(s, F.lit(1), F.lit(32))
    ipv6 = F.concat(F.when(special, F.substr(canon, F.lit(1), F.lit(4))).otherwise(
        F.concat(F.lit("2"), F.substr(bits, F.lit(2), F.lit(3)))), *[F.concat(
            F.lit(":"), F.substr(bits, F.lit(4 * i + 1), F.lit(4))) for i in range(1, 8)])
    octet = lambda i: byte_at(s, F.lit(i)).cast("string")
    octets = F.split(canon, r"\.")
    private = (F.when(canon.startswith("10."), F.concat(F.lit("10."), octet(2)))
               .when(canon.startswith("192.168."), F.lit("192.168"))
               .when(canon.rlike(r"^172\.(1[6-9]|2\d|3[01])\."), F.concat(
                   F.lit("172."), (byte_at(s, F.lit(2)) % 16 + 16).cast("string")))
               .when(canon.startswith("127."), F.concat(F.lit("127."), octet(2)))
               .when(octets[0].cast("int") >= 224, F.concat(octets[0], F.lit("."), octet(2))))
    ip = F.concat_ws(".", F.coalesce(private, F.concat_ws(
        ".", (byte_at(s, F.lit(1)) % 116 + 11).cast("string"), octet(2))), octet(3), octet(4))
    local, domain = F.split(canon, "@")[0], F.split(canon, "@")[1]
    ds = hex_stream(key, F.lit("domain"), domain, F.lit(0), F.length(domain))
    tld = F.when(domain.rlike(r"\.(com|net|org)$"), F.regexp_extract(domain, r"([a-z]+)$", 1)
                 ).otherwise(F.lit("com"))
    email = F.concat(F.regexp_replace(same_format(F.concat(local, F.lit("Z")), s), "[A-Z]$", ""),
                     F.lit("@"), F.regexp_replace(same_format(F.concat(
                         F.split(domain, r"\.")[0], F.lit("Z")), ds), "[A-Z]$", ""),
                     F.lit(".example."), tld)
    keep = F.when(kind == "secret", F.when(canon.startswith("AKIA"), F.concat(
        F.lit("AKIA"), F.substr(num, F.lit(5), F.length(canon)))).otherwise(num))

    gender, whole = F.split(canon, r"\|")[0], F.split(canon, r"\|")[1]

    def name(script: str) -> Column:
        last = F.array_join(F.transform(F.sequence(F.lit(2), F.lit(4) + attempt),
                                        lambda i: pick(SYLLABLES[script], byte_at(s2, i))), "")
        of = {x: GIVEN[(script, x)] for x in "fm"}
        of["n"] = of["f"] + of["m"]
        given = F.coalesce(*[F.when(gender == x, pick(of[x], byte_at(s2, F.lit(1)))) for x in of])
        return F.concat(gender, F.lit("|"), F.when(whole.contains(" "), F.concat(
            given, F.lit(" "))).otherwise(F.lit("")), last)
    s2 = hex_stream(key, kind, canon, attempt, attempt + 8)
    named = F.when(whole.rlike(r"\p{IsCyrillic}"), name("cyrillic")).otherwise(name("latin"))
    return (F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "card", card)
            .when(kind == "ip", ip).when(kind == "ipv6", ipv6).when(kind == "ssn", ssn)
            .when(kind == "iban", iban).when(kind == "name", named).otherwise(keep))


def render(kind: Column, m: Column, sur: Column) -> Column:
    """A canonical surrogate in the spelling of mention ``m``."""
    full = F.when((kind == "phone") & (F.length(digits(m)) == F.length(sur) + 1),
                  F.concat(F.lit("1"), sur)).otherwise(sur)
    filled = F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), lambda i: F.when(
        F.substr(m, i, F.lit(1)).rlike("[A-Z0-9]"),
        F.substr(full, F.length(alnum(F.substr(m, F.lit(1), i))), F.lit(1)))
        .otherwise(F.substr(m, i, F.lit(1)))), "")
    title = F.regexp_extract(m, f"^({TITLE})", 1)
    new = F.split(sur, r"\|")[1]
    shown = F.when(F.regexp_replace(m, f"^{TITLE}", "").rlike(r"\p{Ll}"), F.initcap(new)).otherwise(
        F.upper(new))
    return (F.when(kind.isin("phone", "card", "ssn", "iban"), filled)
            .when(kind == "ipv6", F.when(m.rlike("[A-F]"), F.upper(sur)).otherwise(sur))
            .when(kind == "email", F.when(m.rlike("[a-z]"), sur).otherwise(F.upper(sur)))
            .when(kind == "name", F.concat(title, shown)).otherwise(sur))


def distinct_surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """kind, canon, sur for distinct (kind, canon); surrogates differ from each
    other and from every entity of the kind.  Entities that collide get another
    attempt; the one with the fewest attempts (then the smaller form) stays."""
    now = written(entities.select("kind", "canon", F.lit(0).alias("attempt"))
                  .withColumn("sur", surrogate(key, F.col("kind"), F.col("canon"),
                                               F.col("attempt"))), "pii-try")
    for _ in range(MAX_ROUNDS):
        owner = now.groupBy("kind", "sur").agg(F.min(F.struct("attempt", "canon")).alias("o"))
        real = now.select(F.col("kind").alias("k"), F.col("canon").alias("real"))
        judged = (now.join(owner, ["kind", "sur"])
                  .join(real, (F.col("kind") == F.col("k")) & (F.col("sur") == F.col("real")), "left")
                  .withColumn("bad", F.col("real").isNotNull() | (F.col("o.canon") != F.col("canon"))))
        after = judged.withColumn("attempt", F.col("attempt") + F.col("bad").cast("int")).select(
            "kind", "canon", "attempt", "bad")
        after = written(after, "pii-judged")
        if after.filter("bad").isEmpty():
            return now.select("kind", "canon", "sur")
        now = written(after.select("kind", "canon", "attempt").withColumn(
            "sur", surrogate(key, F.col("kind"), F.col("canon"), F.col("attempt"))), "pii-try")
    raise RuntimeError("no distinct surrogates found; the entities nearly fill their format")


def replace_entities(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in its text column, and ``n_entities_`` added.

    Null and empty texts stay as they are with 0 entities; so do clean texts.
    Repeated texts get equal results.  An empty table stays empty.  All other
    columns are passed on, whatever their names.
    """
    names = docs.columns
    work = docs.toDF(*[f"c{i}" for i in range(len(names))])
    t = F.col(f"c{names.index(text)}")
    mentions = F.when(may_hold(t), F.regexp_extract_all(t, F.lit(MENTION), F.lit(0)))
    work = work.withColumn("m_", mentions)
    has = F.coalesce(F.size("m_") > 0, F.lit(False))
    hit = work.filter(has).withColumn("tk_", F.md5(t))
    found = (hit.select("tk_", F.explode(F.array_distinct("m_")).alias("m")).distinct()
             .withColumn("kind", mention_type(F.col("m"))).filter("kind is not null")
             .withColumn("canon", canonical(F.col("kind"), F.col("m"))))
    found = written(found, "pii-mentions")
    sur = distinct_surrogates(found.select("kind", "canon").distinct(), key)
    swaps = (found.join(sur, ["kind", "canon"])
             .withColumn("new", render(F.col("kind"), F.col("m"), F.col("sur")))
             .groupBy("tk_").agg(F.map_from_entries(F.collect_list(F.struct("m", "new")))
                                 .alias("swap_")))
    joined = hit.join(swaps, "tk_", "left")
    pieces = F.split(t, MENTION, -1)
    new = F.concat(F.transform("m_", lambda m: F.coalesce(F.col("swap_")[m], m)),
                   F.array(F.lit("")))
    swapped = F.array_join(F.zip_with(pieces, new, lambda a, b: F.concat(a, b)), "")
    count = F.size(F.filter("m_", lambda m: F.coalesce(F.map_contains_key("swap_", m), F.lit(False))))
    done = joined.withColumn("text_", F.when(F.col("swap_").isNotNull(), swapped).otherwise(t)
                             ).withColumn("n_", count.cast("long"))
    plain = work.filter(~has).withColumn("text_", t).withColumn("n_", F.lit(0).cast("long"))
    out = [F.col("text_" if n == text else f"c{i}").alias(n) for i, n in enumerate(names)]
    return reduce(DataFrame.unionByName, [d.select(*[c.alias(f"o{i}") for i, c in enumerate(out)],
                                                   F.col("n_").alias("on")) for d in (plain, done)]
                  ).toDF(*names, "n_entities_")


def op10_surrogates(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs).withColumnRenamed("n_entities_", "n_entities")
