"""Mixed timestamp spellings and zones to one UTC instant in microseconds.

Every value is read by one of a few shapes. Where a shape leaves the order of
day and month open, an expectation-maximisation over the possible orders of
each source decides: values that only one order can explain pull the mixture
of their source, the country's custom is its prior, and the posterior of each
value picks its reading or marks it as unresolved.
"""

from __future__ import annotations

import zoneinfo
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.plan import fenced, let

CANONICAL = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z$"

_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
_AMPM = r"(?:\s*([AaPp])\.?[Mm]\.?)?"
_ZONE = r"(?:\s*(Z|z|[A-Za-z]{3,5}|(?:UTC|GMT)?[+-]\d{1,2}(?::?\d{2}(?::?\d{2})?)?))?(?:\s*[\[(]([A-Za-z0-9_/+-]+)[\])])?"
_TAIL = rf"(?:[Tt\s,]+(?:at\s+)?{_TIME}{_AMPM}{_ZONE})?$"
_DAY = r"^(?:[A-Za-z]{3,9},?\s+)?"

#: shape, pattern, replacement that brings the groups into the order
#: year, month, day, hour, minute, second, fraction, am/pm, zone, region, separator
SHAPES = (
    ("ymd", r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})" + _TAIL, "$1~$3~$4~$5~$6~$7~$8~$9~$10~$11~$2"),
    ("basic", rf"^(\d{{4}})(\d{{2}})(\d{{2}})[Tt\s](\d{{2}})(\d{{2}})(?:(\d{{2}})(?:[.,](\d+))?)?{_ZONE}$", "$1~$2~$3~$4~$5~$6~$7~~$8~$9~"),
    ("dmony", _DAY + r"(\d{1,2})[\s-]([A-Za-z]{3,9})\.?[\s-](\d{4})" + _TAIL, "$3~$2~$1~$4~$5~$6~$7~$8~$9~$10~"),
    ("mondy", _DAY + r"([A-Za-z]{3,9})\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})" + _TAIL, "$3~$1~$2~$4~$5~$6~$7~$8~$9~$10~"),
    ("ctime", rf"^[A-Za-z]{{3,9}},?\s+([A-Za-z]{{3,9}})\s+(\d{{1,2}})\s+{_TIME}{_ZONE}\s+(\d{{4}})$", "$9~$1~$2~$3~$4~$5~$6~~$7~$8~"),
    ("open", r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4})" + _TAIL, "$4~$1~$3~$5~$6~$7~$8~$9~$10~$11~$2"),
)
NUMBER = r"^[+-]?\d+(?:\.\d*)?$"

# Hours east of UTC of zone abbreviations.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 1, "bst": 1, "cet": 1, "cest": 2, "eet": 2, "eest": 3, "msk": 3,
    "gst": 4, "pkt": 5, "ist": 5.5, "npt": 5.75, "ict": 7, "wib": 7, "sgt": 8, "hkt": 8, "awst": 8, "pht": 8, "jst": 9, "kst": 9,
    "acst": 9.5, "acdt": 10.5, "aest": 10, "aedt": 11, "nzst": 12, "nzdt": 13, "brt": -3, "brst": -2, "art": -3,
    "nst": -3.5, "ndt": -2.5, "ast": -4, "adt": -3, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6,
    "pst": -8, "pdt": -7, "akst": -9, "akdt": -8, "hst": -10,
}

# Zones of countries whose numeric dates start with the month.
MONTH_FIRST = r"^(America/(New_York|Detroit|Kentucky/.*|Indiana/.*|Chicago|Menominee|North_Dakota/.*|Denver|Boise|Phoenix|Los_Angeles|Anchorage|Juneau|Sitka|Metlakatla|Yakutat|Nome|Adak|Puerto_Rico)|Pacific/(Honolulu|Guam|Pago_Pago)|US/.*|Asia/Manila|[ECMP]ST[5-8][ECMP]DT)$"
# Zones whose countries have no single custom, and zones of no country.
NO_CUSTOM = r"^(America/(St_Johns|Halifax|Toronto|Winnipeg|Regina|Edmonton|Vancouver|Moncton|Glace_Bay|Goose_Bay|Whitehorse|Yellowknife|Iqaluit)|Canada/.*|Etc/.*|UTC|GMT|Z)$"

ORDERS = ("mdy", "dmy")
#: Weight of the country's custom, in values; share it gives to the customary order.
PRIOR_WEIGHT, CUSTOM_SHARE = 50.0, 0.98
#: A reading below this posterior is unresolved.
RESOLVED = 0.8
_ZONES = sorted(z for z in zoneinfo.available_timezones() if z not in ("Factory", "localtime") and not z.startswith(("posix", "right")))


def _int(c: Column) -> Column:
    return F.when(F.length(c) > 0, c).cast("int")


def _offset_seconds(zone: Column) -> Column:
    """Seconds east of UTC of ``Z``, ``UTC+2``, ``-0330``, ``CEST``; null if the text is no known zone."""
    z = F.lower(zone)
    num = F.regexp_replace(z, "^(utc|gmt)(?=[+-])", "")
    sign = F.when(num.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(num, "[^0-9]", "")
    digits = F.when(F.length(digits).isin(1, 3, 5), F.concat(F.lit("0"), digits)).otherwise(digits)
    named = F.create_map(*[F.lit(x) for k, v in ABBREVIATIONS.items() for x in (k, int(v * 3600))])
    part = lambda ds, at: F.coalesce(_int(F.substring(ds, at, 2)), F.lit(0))
    written_out = let(digits, lambda ds: sign * (part(ds, 1) * 3600 + part(ds, 3) * 60 + part(ds, 5)))
    return F.when(num.rlike("^[+-]"), written_out).otherwise(F.try_element_at(named, z))


def _month(text: Column) -> Column:
    at = F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(F.substring(text, 1, 3)))
    return F.when(text.rlike("^[0-9]+$"), F.when(F.length(text) < 3, text).cast("int")).when(
        text.rlike("^[A-Za-z]{3,9}$") & (at > 0) & ((at - 1) % 3 == 0), ((at - 1) / 3).cast("int") + 1
    )


def _days(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01, null for an impossible date."""
    text = F.format_string("%04d-%02d-%02d", y, m, d)
    ok = y.isNotNull() & m.between(1, 12) & d.between(1, 31)
    return F.unix_date(F.when(ok, text).try_cast("date"))


def _number_us(v: Column) -> Column:
    """A pure number in the unit its size implies: below 1e11 seconds, 1e14 ms, 1e17 us, else ns."""
    n = F.regexp_replace(v, r"^\+", "")
    whole = F.regexp_extract(n, r"^(-?\d+)", 1).try_cast("bigint")
    frac = F.rpad(F.regexp_extract(n, r"\.(\d*)$", 1), 6, "0")
    sign = F.when(n.startswith("-"), -1).otherwise(1)
    size = F.abs(whole.cast("double"))
    return (
        F.when(size < 1e11, whole * 1_000_000 + sign * frac.cast("bigint"))
        .when(size < 1e14, whole * 1_000 + sign * F.substring(frac, 1, 3).cast("bigint"))
        .when(size < 1e17, whole)
        .otherwise(F.floor(whole / F.lit(1000).cast("decimal(10,0)")).cast("bigint"))
    )


def _fields(v: Column) -> Column:
    """The parts of a value by its shape, null where no shape fits."""
    text = F.lit(None).cast("string")
    for name, pattern, order in reversed(SHAPES):
        text = F.when(v.rlike(pattern), F.concat(F.lit(name + "~"), F.regexp_replace(v, pattern, order))).otherwise(text)
    return let(
        F.split(text, "~"),
        lambda p: F.struct(
            p[0].alias("shape"), _int(p[1]).alias("y"), _month(p[2]).alias("m"), _int(p[3]).alias("d"),
            F.coalesce(_int(p[4]), F.lit(0)).alias("h"), F.coalesce(_int(p[5]), F.lit(0)).alias("mi"), F.coalesce(_int(p[6]), F.lit(0)).alias("s"),
            F.rpad(F.substring(p[7], 1, 6), 6, "0").cast("bigint").alias("us"), F.lower(p[8]).alias("ap"), p[9].alias("zone"), p[10].alias("region"), p[11].alias("sep"),
        ),
    )


def order_statistics(df: DataFrame, value: str, tz: str) -> dict[tuple[str, str], dict[tuple[bool, bool], int]]:
    """Per source (zone) and separator: how many open dates each set of orders can explain.

    The result has at most zones x separators x 3 rows, so it is small at any input size.
    """
    shape = next(p for n, p, _ in SHAPES if n == "open")
    v = F.trim(F.col(value))
    parts = F.split(F.regexp_replace(v, shape, "$1~$2~$3~$4"), "~")
    a, b, y = parts[0].cast("int"), parts[2].cast("int"), parts[3].cast("int")
    counted = (
        df.where(v.rlike(shape))
        .select(F.coalesce(F.col(tz), F.lit("")).alias("zone"), parts[1].alias("sep"), _days(y, a, b).isNotNull().alias("mdy"), _days(y, b, a).isNotNull().alias("dmy"))
        .groupBy("zone", "sep", "mdy", "dmy")
        .count()
    )
    out: dict = defaultdict(dict)
    for r in counted.collect():
        out[r.zone, r.sep][r.mdy, r.dmy] = r["count"]
    return dict(out)


def fit_orders(stats: dict, rounds: int = 50) -> dict[tuple[str, str], tuple[float, float]]:
    """EM: the share of each order per source and separator, with the country's custom as prior.

    E: a value explained by both orders counts for each by its posterior. M: shares
    are the expected counts plus the prior's.
    """
    import re

    fitted = {}
    for (zone, sep), classes in stats.items():
        prior = (0.5, 0.5) if not zone or re.match(NO_CUSTOM, zone) else (CUSTOM_SHARE, 1 - CUSTOM_SHARE) if re.match(MONTH_FIRST, zone) and sep != "." else (1 - CUSTOM_SHARE, CUSTOM_SHARE)
        weight = PRIOR_WEIGHT if prior[0] != prior[1] else 1.0
        share = prior
        for _ in range(rounds):
            expected = [weight * p for p in prior]
            for can, n in classes.items():
                mass = [s * c for s, c in zip(share, can)]
                if sum(mass):
                    expected = [e + n * m / sum(mass) for e, m in zip(expected, mass)]
            new = tuple(e / sum(expected) for e in expected)
            if abs(new[0] - share[0]) < 1e-12:
                break
            share = new
        fitted[zone, sep] = share
    return fitted


def normalise_instants(df: DataFrame, value: str = "value", tz: str = "tz_name", shares: dict | None = None) -> DataFrame:
    """Adds utc_us (bigint), reading (the shape or order used), posterior (double) and ambiguous.

    ``tz`` names the column with the zone of values that state none. A local time
    that occurs twice is its first occurrence; one skipped by a change counts with
    the offset before it. Digits finer than a microsecond are cut, missing parts of
    a time are zero. Null, blank and unreadable values, impossible dates, and local
    times without a known zone give a null utc_us; an open order below the posterior
    ``RESOLVED`` gives ambiguous = true and its likelier reading. Other columns pass
    through; columns whose names start with ``_`` followed by v, p, f or us are replaced.
    """
    if shares is None:
        shares = fit_orders(order_statistics(df, value, tz))
    known = F.create_map(*[F.lit(x) for (z, sep), (m, _) in shares.items() for x in (f"{z}|{sep}", m)]) if shares else F.create_map().cast("map<string,double>")
    zone_of = F.col(tz)

    def result(utc: Column, reading: Column, posterior: Column) -> Column:
        return F.struct(utc.cast("bigint").alias("utc"), reading.alias("reading"), posterior.cast("double").alias("posterior"))

    def at_zone(f: Column, local: Column) -> Column:
        region = F.when(f["region"] != "", f["region"]).otherwise(zone_of)
        shifted = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), region))
        return F.when(f["zone"] != "", local - _offset_seconds(f["zone"]).cast("bigint") * 1_000_000).when(region.isin(_ZONES), shifted)

    def place(f: Column, days: Column, reading: Column, posterior: Column) -> Column:
        hour = F.when(f["ap"] == "p", f["h"] % 12 + 12).when(f["ap"] == "a", f["h"] % 12).otherwise(f["h"])
        fits = (f["h"] <= F.when(f["ap"] != "", 12).otherwise(23)) & (f["mi"] < 60) & (f["s"] <= 60)
        local = F.when(fits, (days * 86400 + hour * 3600 + f["mi"] * 60 + f["s"]).cast("bigint") * 1_000_000 + f["us"])
        return let(local, lambda at: result(at_zone(f, at), reading, posterior))

    def opened(f: Column) -> Column:
        share = F.coalesce(F.try_element_at(known, F.concat_ws("|", F.coalesce(zone_of, F.lit("")), f["sep"])), F.lit(0.5))
        both = F.struct(_days(f["y"], f["m"], f["d"]).alias("mdy"), _days(f["y"], f["d"], f["m"]).alias("dmy"))

        def choose(x: Column) -> Column:
            first = F.when(x["mdy"].isNull() & x["dmy"].isNull(), None).when(x["mdy"].isNull(), 0.0).when(x["dmy"].isNull(), 1.0).otherwise(share)
            return let(first, lambda p: place(f, F.when(p >= 0.5, x["mdy"]).otherwise(x["dmy"]), F.when(p >= 0.5, F.lit("mdy")).otherwise("dmy"), F.greatest(p, 1 - p)))

        return let(both, choose)

    def read(v: Column) -> Column:
        dated = let(_fields(v), lambda f: F.when(f["shape"] == "open", opened(f)).when(f["shape"].isNotNull(), place(f, _days(f["y"], f["m"], f["d"]), f["shape"], F.lit(1.0))))
        return F.when(v.rlike(NUMBER), result(_number_us(v), F.lit("number"), F.lit(1.0))).otherwise(dated)

    done = df.withColumn("_read", fenced(let(F.regexp_replace(F.col(value), r"^\s+|\s+$", ""), read)))
    stated = F.col("_read.utc").isNotNull()
    return done.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in ("_read", "utc_us", "reading", "posterior", "ambiguous")],
        F.col("_read.utc").alias("utc_us"), F.when(stated, F.col("_read.reading")).alias("reading"), F.when(stated, F.col("_read.posterior")).alias("posterior"),
        F.coalesce(stated & (F.col("_read.posterior") < RESOLVED), F.lit(False)).alias("ambiguous"),
    )


def workspace_of(directory: Column) -> Column:
    """The folder above a directory; a directory is a workspace root or lies one level below it."""
    return F.regexp_replace(directory, r"/[^/]*/?$", "")


def stated_instants(spark, sf: str) -> DataFrame:
    """origin, rec_key, value and zone of every timestamp of the log tables (p3's input)."""
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    ws = read("workspaces").select("project", "root_path", "tz_name")
    not_canonical = lambda c: F.col(c).isNotNull() & ~F.col(c).rlike(CANONICAL)
    parts = []
    for t in ("claude_entries", "qwen_entries"):
        parts.append(read(t).select("project", F.lit(t).alias("origin"), F.col("row_id").cast("string").alias("rec_key"), F.col("timestamp").alias("value")).where(not_canonical("value")))
    conv = read("conversation_records").select("project", F.lit("conversation_records").alias("origin"), F.col("id").alias("rec_key"), F.col("metadata.start_time").alias("value"))
    parts.append(conv.where(not_canonical("value")).distinct())
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    rows = rows.join(ws.drop("root_path"), "project", "left").select("origin", "rec_key", "value", "tz_name")
    ses = read("opencode_session").select("id", "directory", F.col("time_created").alias("value")).where(not_canonical("value")).distinct()
    roots = ws.select(F.col("root_path"), "tz_name")
    ses = ses.withColumn("_dir", F.regexp_replace("directory", "/+$", "")).withColumn("_up", workspace_of(F.col("_dir")))
    here = ses.join(roots, ses["_dir"] == roots["root_path"], "left").withColumnRenamed("tz_name", "_at").drop("root_path")
    both = here.join(roots, here["_up"] == roots["root_path"], "left")
    ses = both.select(F.lit("opencode_session").alias("origin"), F.col("id").alias("rec_key"), "value", F.coalesce("_at", "tz_name").alias("tz_name"))
    return rows.unionByName(ses)


def p3_found(spark, sf: str) -> DataFrame:
    rows = stated_instants(spark, sf)
    done = normalise_instants(rows, "value", "tz_name")
    return done.where(F.col("utc_us").isNotNull()).select("origin", "rec_key", "utc_us")
