"""Column expressions: chromosomes, alleles, INFO strings, numbers as text, identifiers. No UDFs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Median of the chi-square distribution with one degree of freedom.
CHI2_MEDIAN = 0.454936423119572


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullify(c: Column | str, codes: tuple[str, ...] = ("", "NA", ".")) -> Column:
    """NULL where the text is one of the missing codes."""
    return F.when(~col(c).isin(*codes), col(c))


def strip_chr(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "(?i)^chr", "")


#: Labels that are normal already; most rows have one, so they skip the costlier expressions.
PLAIN = [*map(str, range(1, 23)), "X", "Y", "MT"]


def _once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c), where every row evaluates c once however often f mentions it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def _renamed(label: Column, names: dict[str, str | None]) -> Column:
    """label, or what names says of it."""
    pairs = F.create_map(*[F.lit(x).cast("string") for pair in names.items() for x in pair])
    return _once(label, lambda x: F.when(F.map_contains_key(pairs, x), F.element_at(pairs, x)).otherwise(x))


def normalize_chrom(c: Column | str, names: dict[str, str | None] | None = None) -> Column:
    """Upper-cased label without chr; 23, 24 and 25 become X, Y and XY; blank, NA, '.' and 0 become NULL; names has further changes."""
    every = {"23": "X", "24": "Y", "25": "XY", "": None, "NA": None, ".": None, "0": None} | (names or {})
    return F.when(col(c).isin(PLAIN), col(c)).otherwise(_renamed(F.upper(strip_chr(F.trim(col(c)))), every))


def chrom_key(c: Column | str) -> Column:
    """Plot order: numbers as they are, X 23, Y 24, XY and PAR 25, mitochondrial 26; NULL for other labels (chrom_order places them)."""
    keys = {"X": 23, "Y": 24, "XY": 25, "PAR": 25, "M": 26, "MT": 26, "MITO": 26}
    label = normalize_chrom(c)
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in keys.items() for x in pair]), label), label.try_cast("int"))


def collapse_par(c: Column | str) -> Column:
    """Normal labels, with the pseudo-autosomal ones as X."""
    return normalize_chrom(c, {"25": "X", "PAR1": "X", "PAR2": "X", "XY": "X"})


def first_value(*cols: Column | str) -> Column:
    return F.coalesce(*[nullify(c) for c in cols])


def decimal(c: Column | str) -> Column:
    """A double if the text is a decimal number, else NULL; numbers beyond the range of doubles are infinite."""
    x = col(c).cast("string")
    # a cast alone would take white space, words, suffixes and hexadecimal numbers, too; all but the last end
    # otherwise, or begin otherwise, than decimal numbers ('.' to '9', and '+' to '9')
    plain = F.ascii(x).between(43, 57) & F.ascii(F.right(x, F.lit(1))).between(46, 57) & ~F.contains(x, F.lit("x")) & ~F.contains(x, F.lit("X"))
    return F.when(plain, x.try_cast("double"))


def bounded(c: Column | str) -> Column:
    """The number unless it is infinite or NaN."""
    return F.when(F.abs(col(c)) < float("inf"), col(c))


def finite(c: Column | str) -> Column:
    """A double if the text is a finite decimal number, else NULL."""
    return _once(decimal(c), bounded)


def log_odds(beta: Column | str, odds: Column | str) -> Column:
    return F.coalesce(finite(beta), F.ln(finite(odds)))  # NULL for odds that aren't positive


def p_from_log10(c: Column | str) -> Column:
    return F.pow(F.lit(10.0), -finite(c))


def cpra(chrom: Column | str, pos: Column | str, ref: Column | str, alt: Column | str) -> Column:
    return F.concat_ws(":", col(chrom), col(pos).cast("string"), col(ref), col(alt))


def is_rsid(c: Column | str) -> Column:
    return col(c).rlike("^rs[0-9]+$")


def is_palindromic(a: Column | str, b: Column | str) -> Column:
    return F.concat(F.least(col(a), col(b)), F.greatest(col(a), col(b))).isin("AT", "CG")


def info_flag(info: Column | str, flag: str) -> Column:
    return F.coalesce(F.array_contains(F.split(col(info), ";"), flag), F.lit(False))


def info_value(info: Column | str, key: str) -> Column:
    """The value of the first KEY=value item, keys compared in upper case."""
    hit = F.filter(F.split(col(info), ";"), lambda x: F.upper(F.substring_index(x, "=", 1)) == key.upper())
    item = F.get(F.filter(hit, lambda x: F.contains(x, F.lit("="))), F.lit(0))
    return F.substr(item, F.lit(len(key) + 2))


def split_csv(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(col(c), ","), F.trim), lambda x: x != "")


def safe_name(c: Column | str) -> Column:
    """Anything outside letters, digits, '.', '_' and '-' becomes one '_'; none at either end."""
    return F.regexp_replace(F.regexp_replace(col(c), "[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")


def probit(p: Column | str) -> Column:
    """The normal quantile, by Wichura's rational approximations (AS 241)."""
    p = col(p)

    def ratio(x: Column, a: list[float], b: list[float]) -> Column:
        def poly(k: list[float]) -> Column:
            out = F.lit(k[-1])
            for v in reversed(k[:-1]):
                out = out * x + F.lit(v)
            return out

        return poly(a) / poly(b)

    # The coefficients of AS 241.
    a = [3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125, 45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727]
    b = [1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077, 21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610]
    c = [1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504, 1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640]
    d = [1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550, 0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 1.05075007164441684324e-9]
    e = [6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230, 0.0265321895265761230930, 0.00124266094738807843860, 0.0000271155556874348757815, 2.01033439929228813265e-7]
    f = [1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525, 0.000786869131145613259100, 0.0000184631831751005468180, 1.42151175831644588870e-7, 2.04426310338993978564e-15]
    q = p - 0.5
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.when(r <= 5, ratio(r - 1.6, c, d)).otherwise(ratio(r - 5, e, f))
    return F.when(F.abs(q) <= 0.425, q * ratio(0.180625 - q * q, a, b)).otherwise(F.when(q < 0, -tail).otherwise(tail))


def chi2_quantile(p: Column | str) -> Column:
    """Chi-square with one degree of freedom whose upper tail is p."""
    z = probit(col(p) / 2)
    return z * z


def minus_log10(p: Column | str) -> Column:
    return -F.log10(col(p))


def covariate_list(*lists: list[str]) -> list[str]:
    """The names of all lists, each once, in order of their first mention."""
    return list(dict.fromkeys(n.strip() for names in lists for n in names if n.strip()))


def fmt_decimal(c: Column | str, digits: int = 6) -> Column:
    """Fixed decimals, NA where there is no finite number."""
    x = col(c).cast("double")
    return F.coalesce(F.when((F.abs(x) < float("inf")) & ~F.isnan(x), F.format_string(f"%.{digits}f", x)), F.lit("NA"))


def fmt_percent(part: Column | str, whole: Column | str, digits: int = 6) -> Column:
    """100 x part / whole with fixed decimals, NA of nothing."""
    return F.coalesce(F.when(col(whole) != 0, F.format_string(f"%.{digits}f", 100.0 * col(part) / col(whole))), F.lit("NA"))


def fmt_thousands(c: Column | str) -> Column:
    return F.format_number(col(c), 0)


def collapse(values: Column | str, separator: str = ";") -> Column:
    """The different values of an array as one text."""
    return F.array_join(F.array_distinct(F.transform(col(values), lambda x: x.cast("string"))), separator)


def replacement_id(kind: str, row: Column | str) -> Column:
    return F.concat(F.lit(f"__invalid_{kind}_row_"), col(row).cast("string"))


def group_id(kind: Column | str, trait: Column | str) -> Column:
    return F.concat_ws("__", col(kind), col(trait))
