"""Resolving inputs: paths, kinds, companions, copies and conflicts, resolution, what is done already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the slide file kinds that are read
EXTENSIONS = ("svs", "sdpc", "kfb", "mrxs", "ndpi", "tif", "tiff", "tmap", "mds", "mdsx", "tron", "isyntax", "czi", "dcm")


def unquoted(path: Column) -> Column:
    """Without outer blanks and one pair of equal quotes."""
    return F.regexp_replace(F.trim(path), "^(['\"])(.*)\\1$", "$2")


def absolute(path: Column, root: str) -> Column:
    return F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, "\\.([^./]+)$", 1))


def dicom_entry(files: DataFrame) -> DataFrame:
    """directory, name to directory, entry: 4_1.dcm, else the first 4_*, else the first *.dcm, else null."""
    rank = F.when(F.col("name") == "4_1.dcm", 0).when(F.startswith("name", F.lit("4_")), 1).when(F.endswith("name", F.lit(".dcm")), 2)
    return files.withColumn("rank", rank).groupBy("directory").agg(F.min(F.when(F.col("rank").isNotNull(), F.struct("rank", "name")))["name"].alias("entry"))


def deduplicated(inputs: DataFrame) -> DataFrame:
    """action of each input: keep (the first of its slide_id), skip (same content as that one) or conflict.

    Ids are counted without contents; contents are read only of inputs whose id is taken, and hashed where they are read.
    """
    many = inputs.groupBy("slide_id").agg(F.count("*").alias("n"), F.min("ordinal").alias("first")).where("n > 1").drop("n")
    own = inputs.join(many, "slide_id").select("ordinal", "slide_id", "first", F.sha2("content", 256).alias("checksum"))
    first = own.where("ordinal = first").select("slide_id", F.col("checksum").alias("first_checksum"))
    same = F.col("checksum").eqNullSafe(F.col("first_checksum"))
    told = own.join(first, "slide_id").select("ordinal", "slide_id", F.when(F.col("ordinal") == F.col("first"), "keep").when(same, "skip").otherwise("conflict").alias("action"))
    rest = inputs.drop("content").join(told, ["ordinal", "slide_id"], "left")
    return rest.withColumn("action", F.coalesce("action", F.lit("keep")))


def mean_mpp(text: Column) -> Column:
    """Mean of the positive finite numbers in a text, parted by commas, semicolons, backslashes or blanks; else null."""
    numbers = F.transform(F.split(text, "[,;\\\\\\s]+"), lambda x: x.try_cast("double"))
    good = F.filter(numbers, lambda x: x.isNotNull() & (x > 0) & (x < float("inf")))
    return F.when(F.size(good) > 0, F.aggregate(good, F.lit(0.0), lambda a, x: a + x) / F.size(good))


def pending(slides: DataFrame, done: DataFrame) -> DataFrame:
    return slides.join(done, "slide_id", "left_anti")


def resumed(plans: DataFrame, done: DataFrame) -> DataFrame:
    """status: skipped where the file is there already, else pending."""
    return plans.join(done.withColumn("_there", F.lit(True)), ["slide_id", "name"], "left").withColumn("status", F.when(F.col("_there"), "skipped").otherwise("pending")).drop("_there")


def device(request: Column) -> Column:
    """A device by request: none means any, a number that of CUDA."""
    text = F.trim(request)
    return F.when(request.isNull() | request.isin("", "null"), "auto").when(text.rlike("^[0-9]+$"), F.concat(F.lit("cuda:"), text)).otherwise(text)


def numbers(text: Column) -> Column:
    """The positive finite numbers in a text, parted by commas, semicolons, backslashes or blanks."""
    return F.filter(F.transform(F.split(F.trim(text), "[,;\\\\\\s]+"), lambda x: x.try_cast("double")), lambda x: x.isNotNull() & (x > 0) & (x < float("inf")))


def resolution(properties: Column, direct: Column) -> Column:
    """Microns a pixel from the direct value, or a map of properties: by axis, for both axes, or in millimetres."""
    from ..sources.readers import BOTH_KEYS, MILLIMETRE_KEYS, X_KEYS, Y_KEYS

    low = F.transform_keys(properties, lambda k, v: F.lower(k))
    of = lambda key: numbers(F.try_element_at(low, F.lit(key)))
    mean = lambda a: F.when(F.size(a) > 0, F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a))
    axes = F.filter(F.array(*[F.get(of(k), F.lit(0)) for k in X_KEYS + Y_KEYS]), lambda x: x.isNotNull())
    return F.coalesce(mean(numbers(direct)), mean(axes), *[mean(of(k)) for k in BOTH_KEYS], *[1000 * mean(of(k)) for k in MILLIMETRE_KEYS])
