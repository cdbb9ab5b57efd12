"""Format-preserving pseudonyms for personal data, by keyed Feistel networks in DataFrame functions alone.

One pattern finds what may be personal: e-mail addresses, IPv4 and IPv6 addresses, dates, phone numbers, social security numbers, IBANs,
payment cards and secrets after a name such as ``password=``. What validates (Luhn, mod 97, calendar, octets, number plans) is
permuted within its own format by a network whose rounds are keyed hashes, so equal values get equal pseudonyms in every
document, different values different ones, and a pseudonym validates like the value it stands for:

* numbers and dates: a value is a pair in Z_a x Z_b (a card without first and check digit, the two halves of an address, the day
  in a 400-year cycle); rounds add the hash of one half to the other half, modulo its size;
* texts (mailboxes, domains without the last label, secrets, account numbers): rounds shift every letter or digit of one half
  inside its own class by the hash of the other half.

Nothing is shuffled: a row is rewritten where it lies. Rows: a null text stays null, an empty text empty; texts of any length are
read whole; what does not validate stays as it is; repeated rows are rewritten alike; all columns of the input are kept, the
names of added columns start with ``pii_``; an empty table gives no rows.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import fresh, table

#: Where the session's configuration holds the key.
KEY_SETTING = "spark.tessella.pii.key"
ROUNDS = 8

#: Formats of personal data.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[\p{L}0-9-]+(?:\.[\p{L}0-9-]+){0,126}\.[A-Za-z]{2,24}(?![\p{L}0-9-])"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)"
#: Eight groups, or a compressed address with a digit and two groups on one side of its double colon.
IPV6 = r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]{0,40}\d)(?:(?:[0-9A-Fa-f]{1,4}:){2,6}(?::[0-9A-Fa-f]{1,4}){1,5}|[0-9A-Fa-f]{1,4}:(?::[0-9A-Fa-f]{1,4}){2,6}))(?![0-9A-Za-z:]|\.\d)"
DATE = r"(?<![\d/.-])(?:(?:1[89]|2[01])\d\d-\d\d-\d\d|\d{1,2}\.\d{1,2}\.(?:1[89]|2[01])\d\d|\d\d/\d\d/(?:1[89]|2[01])\d\d|(?:1[89]|2[01])\d\d/\d\d/\d\d)(?![\d/-])"
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .-]\d{2,4}){2,4}(?!\d)|(?<![\d+])\+\d{8,15}(?!\d)|" + "|".join([
    r"(?<![\d-])(?:1[ .-])?\d{3}-\d{3}-\d{4}(?![\d-])", r"(?<![\d.])(?:1[ .-])?\d{3}\.\d{3}\.\d{4}(?!\d|\.\d)", r"(?<!\d)(?<!\d[ .-])(?:1[ .-])?\d{3} \d{3} \d{4}(?![\d-]| \d)",
    r"(?<!\d)(?<!\d[ .])0[1-9](?:[ .]\d\d){4}(?![ .]?\d)", r"(?<!\d)(?<!\d[ ./-])0[1-9]\d{1,3}[ /-]\d{6,8}(?![ .-]?\d)",
])
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
#: Length of an account number by country; of a spaced one it tells where it ends.
LENGTHS = """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18
FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22
MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23
TN24 TR26 UA29 VA22 VG24 XK20 YE30""".split()


def _spaced(n: int) -> str:
    lands = "|".join(x[:2] for x in LENGTHS if int(x[2:]) == n)
    return rf"(?:{lands})\d\d(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + rf" [A-Z0-9]{{{n % 4}}}" * bool(n % 4)


#: In small letters only where the length is that of the country.
SMALL = "|".join(f"(?:{'|'.join(x[:2].lower() for x in LENGTHS if int(x[2:]) == n)})[0-9]{{2}}[a-z0-9]{{{n - 4}}}" for n in sorted({int(x[2:]) for x in LENGTHS}))
#: In one piece, or in groups of four; in countries without a known length the groups go as far as they can.
GROUPS = "|".join([*map(_spaced, sorted({int(x[2:]) for x in LENGTHS})), r"[A-Z]{2}\d\d(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?"])
IBAN = rf"(?<![A-Za-z0-9])(?:[A-Z]{{2}}\d\d[A-Z0-9]{{11,30}}|{GROUPS}|{SMALL})(?![A-Za-z0-9])"
CARD = r"(?<!\d)(?:\d{13,19}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})(?!\d)"
NAMED = r"(?i:password|passwd|pwd|token|secret|api_?key) {0,2}[=:] {0,2}[\"']?"
#: How tokens of well-known services begin.
PREFIX = r"(?<![A-Za-z0-9_-])(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk-|sk_live_|pk_live_|npm_|hf_)"
#: Three parts of a signed token, of which the first begins like an encoded object; and long passwords without a digit.
SIGNED = r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{5,}+\.[A-Za-z0-9_-]{5,}+\.[A-Za-z0-9_-]{5,}+"
PASSWORD = r"(?i:password|passwd|pwd) {0,2}[=:] {0,2}[\"']?"
SECRET = rf"{SIGNED}|AKIA[0-9A-Z]{{16}}(?![A-Z0-9])|{NAMED}[A-Za-z0-9_/+-]{{8,}}+|{PREFIX}[A-Za-z0-9_-]{{16,}}+"
ANY = "|".join([SECRET, EMAIL, IPV6, IPV4, DATE, PHONE, SSN, IBAN, CARD])
#: What every match holds; texts without it are not searched further.
SIGN = "[0-9@]|(?i:password|passwd|pwd)|eyJ"

CYCLE_START, CYCLE = "1800-01-01", (189, 773)  # 189 x 773 = 146,097 days of 400 years


def _keyed(key: str, what: Column | str, i: Column, x: Column) -> Column:
    """64 hexadecimal digits of the keyed hash of round ``i`` over ``x``."""
    inner = F.sha2(F.concat_ws("|", F.lit(key), F.lit(what) if isinstance(what, str) else what, i.cast("string"), x.cast("string")), 256)
    return F.sha2(F.concat(F.lit(key), inner), 256)


def _number(hexed: Column) -> Column:
    return F.conv(F.substring(hexed, 1, 15), 16, 10).cast("bigint")


def feistel(key: str, what: str, left: Column, right: Column, a: Column, b: Column) -> Column:
    """struct(l, r): the permuted pair of Z_a x Z_b."""
    state = lambda x, y: F.struct(x.cast("bigint").alias("l"), y.cast("bigint").alias("r"))

    def step(s: Column, i: Column) -> Column:
        to_left = state(F.pmod(s["l"] + F.pmod(_number(_keyed(key, what, i, s["r"])), a), a), s["r"])
        return F.when(i % 2 == 0, to_left).otherwise(state(s["l"], F.pmod(s["r"] + F.pmod(_number(_keyed(key, what, i, s["l"])), b), b)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), state(left, right), step)


def _chars(x: Column) -> Column:
    return F.sequence(F.lit(1), F.greatest(F.length(x), F.lit(1)))


def _shifted(x: Column, hashed, small: Column) -> Column:
    """``x`` with every digit and letter moved inside its class; ``hashed(block)`` gives 64 hexadecimal digits for 16 places."""

    def one(at: Column) -> Column:
        c = F.substr(x, at, F.lit(1))
        h = F.conv(F.substr(hashed(F.floor((at - 1) / 16)), F.pmod(at - 1, F.lit(16)) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        move = lambda base, n: F.char(F.pmod(F.ascii(c) - F.lit(base) + h, n) + F.lit(base))
        return F.when(c.between("0", "9"), move(48, F.lit(10))).when(c.between("a", "z"), move(97, F.when(small, 6).otherwise(26))).when(c.between("A", "Z"), move(65, F.lit(26))).otherwise(c)

    return F.array_join(F.transform(_chars(x), one), "")


def text_feistel(key: str, what: str, x: Column) -> Column:
    """A text permuted within the class of each of its characters; what is all hexadecimal in small letters stays so."""
    half = F.floor(F.length(x) / 2).cast("int")
    state = lambda a, b, small: F.struct(a.alias("l"), b.alias("r"), small.alias("s"))
    first = state(F.substr(x, F.lit(1), half), F.substr(x, half + 1, F.length(x)), x.rlike("^[0-9a-f]+$"))

    def step(s: Column, i: Column) -> Column:
        of = lambda other: lambda block: _keyed(key, F.concat(F.lit(f"{what}:"), block.cast("string")), i, other)
        return F.when(i % 2 == 0, state(_shifted(s["l"], of(s["r"]), s["s"]), s["r"], s["s"])).otherwise(state(s["l"], _shifted(s["r"], of(s["l"]), s["s"]), s["s"]))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, step, lambda s: F.concat(s["l"], s["r"]))


def digits_of(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _filled(form: Column, digits: Column, kind: str = "0-9") -> Column:
    """The digits (or other characters of the class ``kind``) of ``form`` replaced, in order, by ``digits``."""

    def one(at: Column) -> Column:
        c = F.substr(form, at, F.lit(1))
        return F.when(c.rlike(f"[{kind}]"), F.substr(digits, F.length(F.regexp_replace(F.substr(form, F.lit(1), at), f"[^{kind}]", "")), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_chars(form), one), "")


def _digit_feistel(key: str, what: str, digits: Column) -> Column:
    """Up to 36 digits permuted among all strings of as many digits (at least two)."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    power = lambda k: F.pow(F.lit(10.0), k).cast("bigint")
    out = feistel(key, what, F.substr(digits, F.lit(1), half), F.substr(digits, half + 1, n), power(half), power(n - half))
    pad = lambda v, k: F.lpad(v.cast("string"), k, F.lit("0"))
    return F.concat(pad(out["l"], half), pad(out["r"], n - half))


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum modulo 10; 0 for a valid number."""
    n = F.length(digits)

    def add(total: Column, at: Column) -> Column:
        d = F.substr(digits, at, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(F.pmod(n - at, F.lit(2)) == 1, twice).otherwise(d)

    return F.pmod(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add), F.lit(10))


def mod97(account: Column) -> Column:
    """The remainder of an IBAN; 1 for a valid one."""
    moved = F.concat(F.substr(account, F.lit(5), F.length(account)), F.substr(account, F.lit(1), F.lit(4)))

    def add(r: Column, at: Column) -> Column:
        c = F.substr(moved, at, F.lit(1))
        return F.when(c.between("0", "9"), F.pmod(r * 10 + F.ascii(c) - 48, F.lit(97))).otherwise(F.pmod(r * 100 + F.ascii(c) - 55, F.lit(97)))

    return F.aggregate(_chars(moved), F.lit(0), add)


def _card(key: str, m: Column) -> Column:
    d = digits_of(m)
    n = F.length(d)
    body = F.concat(F.substr(d, F.lit(1), F.lit(1)), _digit_feistel(key, "card", F.substr(d, F.lit(2), n - 2)))
    # by a one-element array, so that the network runs once
    full = F.element_at(F.transform(F.array(body), lambda b: F.concat(b, F.pmod(-luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string"))), 1)
    return F.when(luhn_sum(d) == 0, _filled(m, full)).otherwise(m)


def _iban(key: str, m: Column) -> Column:
    """The country stays, and the blanks between groups of four, or small letters; the pseudonym doesn't depend on them."""
    plain = F.upper(F.replace(m, F.lit(" "), F.lit("")))

    def made(body: Column) -> Column:
        land = F.substr(plain, F.lit(1), F.lit(2))
        return F.concat(land, F.lpad((98 - mod97(F.concat(land, F.lit("00"), body))).cast("string"), 2, F.lit("0")), body)

    body = text_feistel(key, "iban", F.substr(plain, F.lit(5), F.length(plain)))
    out = F.element_at(F.transform(F.array(body), made), 1)
    spelled = F.when(F.contains(m, F.lit(" ")), F.regexp_replace(out, "(.{4})(?=.)", "$1 ")).when(m.rlike("[a-z]"), F.lower(out)).otherwise(out)
    return F.when(mod97(plain) == 1, spelled).otherwise(m)


def _date(key: str, m: Column) -> Column:
    def of(form: str) -> Column:
        day = F.datediff(F.try_to_date(m, form), F.lit(CYCLE_START).cast("date"))
        a, b = map(F.lit, CYCLE)
        out = feistel(key, "date", F.floor(day / b), F.pmod(day, b), a, b)
        return F.date_format(F.date_add(F.lit(CYCLE_START).cast("date"), (out["l"] * b + out["r"]).cast("int")), form)

    slash = F.coalesce(of("MM/dd/yyyy"), of("dd/MM/yyyy"))
    forms = F.when(m.rlike("^[0-9]{4}/"), of("yyyy/MM/dd")).when(F.contains(m, F.lit("/")), slash)
    return F.coalesce(forms.when(m.rlike(r"^[0-9]{2}\.[0-9]{2}\."), of("dd.MM.yyyy")).when(F.contains(m, F.lit(".")), of("d.M.yyyy")).otherwise(of("yyyy-MM-dd")), m)


def _ipv4(key: str, m: Column) -> Column:
    o = [F.split_part(m, F.lit("."), F.lit(i + 1)).cast("bigint") for i in range(4)]
    out = feistel(key, "ipv4", o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536))
    return F.concat_ws(".", *[f.cast("string") for x in ("l", "r") for f in (F.floor(out[x] / 256), F.pmod(out[x], F.lit(256)))])


def _ipv6(key: str, m: Column) -> Column:
    """The groups keep their lengths; letters are small unless the address has large ones. Other spellings of one address are other values."""
    out = _filled(m, text_feistel(key, "ipv6", F.lower(F.replace(m, F.lit(":"), F.lit("")))), "0-9A-Fa-f")
    return F.when(m.rlike("[A-F]"), F.upper(out)).otherwise(out)


def _ssn(key: str, m: Column) -> Column:
    area, group, serial = (F.split_part(m, F.lit("-"), F.lit(i)).cast("bigint") for i in (1, 2, 3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    out = feistel(key, "ssn", area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999))
    new = out["l"] + F.when(out["l"] >= 665, 2).otherwise(1)
    pad = lambda v, k: F.lpad(v.cast("string"), k, F.lit("0"))
    return F.when(valid, F.concat_ws("-", pad(new, 3), pad(F.floor(out["r"] / 9999) + 1, 2), pad(F.pmod(out["r"], F.lit(9999)) + 1, 4))).otherwise(m)


def _phone(key: str, m: Column) -> Column:
    """The country code stays. Ten digits of the North American plan stay in it; others keep their first digit."""
    code = F.regexp_extract(m, r"^(\+\d{1,3}(?=[ .(-])[ .-]?|\+\d\d?|1[ .-]|)", 1)
    rest = F.substr(m, F.length(code) + 1, F.length(m))
    d = digits_of(rest)
    n = F.length(d)
    area, exchange = F.substr(d, F.lit(1), F.lit(3)).cast("bigint"), F.substr(d, F.lit(4), F.lit(3)).cast("bigint")
    plan = (digits_of(code).isin("", "1")) & (n == 10) & (area >= 200) & (exchange >= 200)
    out = feistel(key, "phone", area - 200, (exchange - 200) * 10000 + F.substr(d, F.lit(7), F.lit(4)).cast("bigint"), F.lit(800), F.lit(8_000_000))
    nanp = F.concat((out["l"] + 200).cast("string"), (out["r"] + 2_000_000).cast("string"))
    other = F.concat(F.substr(d, F.lit(1), F.lit(1)), _digit_feistel(key, "phone", F.substr(d, F.lit(2), n - 1)))
    return F.when(n < 6, m).otherwise(F.concat(code, _filled(rest, F.when(plan, nanp).otherwise(other))))


def _email(key: str, m: Column) -> Column:
    local, domain = F.split_part(m, F.lit("@"), F.lit(1)), F.split_part(m, F.lit("@"), F.lit(2))
    last = F.substring_index(domain, ".", -1)
    name = F.substr(domain, F.lit(1), F.length(domain) - F.length(last) - 1)
    return F.concat(text_feistel(key, "local", local), F.lit("@"), text_feistel(key, "domain", name), F.lit("."), last)


def _secret(key: str, m: Column) -> Column:
    """The name in front of a secret, and its quote, stay; a value without a digit is a word, not a secret, but for a password of 16 letters or more."""
    name = F.regexp_extract(m, f"^(eyJ|AKIA|{NAMED}(?:{PREFIX})?|{PREFIX})", 1)
    value = F.substr(m, F.length(name) + 1, F.length(m))
    secret = value.rlike("[0-9]") | (m.rlike(f"^{PASSWORD}") & (F.length(value) >= 16))
    return F.when(secret, F.concat(name, text_feistel(key, "secret", value))).otherwise(m)


#: Kind, test of a whole match, and the pseudonym; the first test that holds decides.
KINDS = [
    ("email", r"^[^@]+@", _email), ("ipv6", r"^[0-9A-Fa-f:]*:[0-9A-Fa-f]*:[0-9A-Fa-f:]*$", _ipv6), ("ipv4", rf"^(?:{OCTET}\.){{3}}{OCTET}$", _ipv4), ("date", r"^(?:\d{4}-\d\d-\d\d|\d{1,2}\.\d{1,2}\.\d{4}|\d\d/\d\d/\d{4}|\d{4}/\d\d/\d\d)$", _date),
    ("ssn", r"^\d{3}-\d{2}-\d{4}$", _ssn), ("phone", r"^(?:[+(]|(?:1[ .-])?\d{3}([ .-])\d{3}\1\d{4}$|0[1-9](?:[ .]\d\d){4}$|0[1-9]\d{1,3}[ /-]\d{6,8}$)", _phone), ("card", r"^\d[\d -]{12,}$", _card), ("iban", r"^(?:[A-Z]{2}\d\d(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{1,4})+)|[a-z]{2}\d\d[a-z0-9]{11,30})$", _iban),
]


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one match; the match itself where it does not validate."""
    out = _secret(key, m)
    for _, test, made in reversed(KINDS):
        out = F.when(m.rlike(test), made(key, m)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str | None = None, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``text_col`` rewritten, and ``pii_values``: struct(value, pseudonym) of each match, in order.

    ``key`` is the session's unless it is given; without either this is an error. The values are the last column; where ``docs`` has
    one of that name already, it has underscores in front.
    """
    key = docs.sparkSession.conf.get(KEY_SETTING, None) if key is None else key
    if not key:
        raise ValueError(f"pseudonyms need a secret key: set {KEY_SETTING}")
    found, made, values = (fresh(docs, name) for name in ("pii_found", "pii_made", "pii_values"))
    matches = F.when(F.col(text_col).rlike(SIGN), F.regexp_extract_all(F.col(text_col), F.lit(ANY), F.lit(0)))
    out = docs.withColumn(found, F.coalesce(matches, F.array().cast("array<string>")))
    out = out.withColumn(made, F.transform(found, lambda m: pseudonym(m, key)))
    between = F.split(F.col(text_col), ANY, -1)
    joined = F.array_join(F.zip_with(between, F.concat(made, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    out = out.withColumn(text_col, F.when(F.size(found) == 0, F.col(text_col)).otherwise(joined))
    pairs = F.zip_with(found, made, lambda a, b: F.struct(a.alias("value"), b.alias("pseudonym")))
    return out.withColumn(values, pairs).drop(found, made)


def with_key(spark: SparkSession) -> SparkSession:
    """A session without a key gets a random one, which nobody knows: its pseudonyms are linked within the session only."""
    if not spark.conf.get(KEY_SETTING, None):
        spark.conf.set(KEY_SETTING, secrets.token_hex(32))
    return spark


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms, and how many values were replaced."""
    out = pseudonymise(table(with_key(spark), sf_dir, "documents").select("doc_id", "text"))
    changed = F.size(F.filter("pii_values", lambda v: v["value"] != v["pseudonym"]))
    return out.select("doc_id", "text", changed.alias("n_values"))
