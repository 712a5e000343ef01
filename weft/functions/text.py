"""Names, expressions and paths as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_word(name: Column) -> Column:
    """First run of letters, 'unknown' if there is none."""
    found = F.get(F.filter(F.split(F.regexp_replace(name, r"[^\p{L}]", " "), " +"), lambda x: x != ""), F.lit(0))
    return F.coalesce(found, F.lit("unknown"))


def category(name: Column) -> Column:
    """Token before the first underscore."""
    return F.substring_index(name, "_", 1)


def model_instance(name: Column) -> Column:
    """Without the last three tokens; of a name with fewer underscores only the first token is left."""
    parts = F.split(name, "_")
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 3, F.lit(1))), "_")


def second_token(name: Column) -> Column:
    return F.get(F.split(name, "_"), F.lit(1))


def batch_numbers(path: Column) -> Column:
    """Batch and number of batches as in batch_1_of_4, 0 and 1 where the path has none."""
    def part(n: int, default: str) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(path, r"batch_(\d+)_of_(\d+)", n), F.lit("")), F.lit(default))

    return F.struct(part(1, "0").alias("batch"), part(2, "1").alias("batches"))


def object_hash(name: Column) -> Column:
    """What lies between a name's word and its three numbers, null for other names."""
    return F.nullif(F.regexp_extract(name, r"^[a-zA-Z][a-zA-Z0-9]*_(.+)_[0-9]+_[0-9]+_[0-9]+$", 1), F.lit(""))


def hex32(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, "([0-9a-f]{32})", 1), F.lit(""))


def normalised(expression: Column) -> Column:
    """Lower case, underscores as spaces, without punctuation or outer spaces."""
    return F.trim(F.translate(F.translate(F.lower(F.trim(expression)), "_", " "), ".;/,'\"\\", ""))


def spaced(camel: Column) -> Column:
    """Words of a camel-case name, lower-cased."""
    return F.lower(F.regexp_replace(camel, "([a-z0-9])([A-Z])", "$1 $2"))


def fallback_name(name: Column) -> Column:
    """A readable name of an identifier: without its last four tokens, digits and the prefix obja."""
    parts = F.split(name, "_")
    head = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 4, F.lit(1))), " ")
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(head, "[0-9]", ""), "^obja", ""), " +", " "))


def variants(name: Column) -> Column:
    """The name with spaces, without, and with underscores."""
    return F.array(name, F.replace(name, F.lit(" "), F.lit("")), F.replace(name, F.lit(" "), F.lit("_")))


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(.)\.[^.]*$", "$1")


def parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def relative(path: Column, root: str) -> Column:
    """Path below a root; other paths stay."""
    return F.when(path.startswith(root + "/"), F.substring(path, F.lit(len(root) + 2), F.length(path))).otherwise(path)


def human_size(n: Column) -> Column:
    """Bytes with a unit and two digits."""
    out = F.format_string("%.2f TiB", n / F.lit(1024.0**4))
    for power, unit in ((3, "GiB"), (2, "MiB"), (1, "KiB")):
        out = F.when(n < 1024 ** (power + 1), F.format_string(f"%.2f {unit}", n / F.lit(1024.0**power))).otherwise(out)
    return F.when(n < 1024, F.format_string("%d B", n)).otherwise(out)


def task_type(path: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """First rule (substring, type) that the lower-cased path meets."""
    out = F.lit(default)
    for part, name in reversed(rules):
        out = F.when(F.lower(path).contains(part), name).otherwise(out)
    return out


def natural_key(name: Column) -> Column:
    """Sort key under which numbers in names sort as numbers: every run of digits padded to twelve."""
    runs = F.regexp_extract_all(name, F.lit("([0-9]+|[^0-9]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.when(x.rlike("^[0-9]"), F.lpad(x, 12, "0")).otherwise(x)), "")


def seed(*parts: Column) -> Column:
    """A number from the first eight hexadecimal digits of the sha256 of the parts joined by |."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 8), 16, 10).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that only depends on the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
