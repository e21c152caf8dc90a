"""URL filters: a blocked Bloom filter in front of an exact hash join. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 4  # 64-bit words in a block; a key sets one bit in each


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host between the first '://' and the next of / ? #, with A-Z lower-cased; path from there to ? or #.

    A null url, or one without '://', has an empty host and path.
    """
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """One mask for each word of the key's block, from a second hash."""
    h = F.xxhash64(key, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 7 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3) of the column key: the OR of the masks of each block. It has at most `blocks` rows."""
    masks = _bits(F.col("key"))
    return keys.select(_block(F.col("key"), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)]).groupBy("block").agg(
        *[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]
    )


def judge(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", most_broadcast: int = 1 << 20) -> DataFrame:
    """One row for each row of `urls`: id, host, path, the rule that wins (host + path, else null) and the verdict.

    rules: host, path, verdict. A rule fits its host and that host's subdomains where the url's path starts
    with the rule's path; the longest fitting rule wins, the one with the longer host at equal length, and
    'block' if one rule is listed with both verdicts.
    Each url has as candidate keys its last labels joined with its path's prefixes, as long as listed rules
    are. Candidates that the Bloom filter passes go to an exact join with the rules. The filter has a block of 36
    bytes for eight rules, and is broadcast up to `most_broadcast` blocks; a larger one is joined by its block. Only two
    numbers and the rules' distinct path lengths reach the driver. Equal rows are judged once for each of up to 32
    groups of input partitions and counted, so a row that fills a third of the table is few rows of the join. Null and
    malformed urls get the default verdict; null ids are kept. An empty table gives an empty result, empty rules the
    default. Urls are read whole; other columns are not read.
    """
    rules = (
        rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("h"), F.coalesce("path", F.lit("")).alias("p"), "verdict")
        .groupBy("h", "p").agg(F.max(F.struct((F.col("verdict") == "block").alias("b"), "verdict"))["verdict"].alias("verdict"))
        .select(F.concat("h", "p").alias("key"), F.length("h").alias("hl"), F.length("p").alias("pl"), F.size(F.split("h", r"\.")).alias("labels"), "verdict")
    )
    shape = rules.agg(F.max("labels").alias("labels"), F.count("*").alias("n"), F.sort_array(F.collect_set("pl")).alias("lengths")).first()
    labels, lengths = shape["labels"] or 1, shape["lengths"] or [0]
    blocks = max(16, 1 << (int(shape["n"]) // 8).bit_length())

    host, path = split_url(F.col(url_col))
    page = urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), (F.spark_partition_id() % 32).alias("part"))
    page = page.groupBy("id", "host", "path", "part").agg(F.count("*").alias("copies"))
    tails = F.expr(f"transform(sequence(1, least(size(split(host, '[.]')), {labels})), k -> substring_index(host, '.', -k))")
    heads = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n) if n else F.lit("")) for n in lengths])
    keys = F.flatten(F.transform(tails, lambda t: F.transform(F.filter(heads, lambda x: x.isNotNull()), lambda x: F.concat(t, x))))
    # each page keeps a row of its own, which no rule meets; its key is the id, so that these rows spread over all tasks
    own = F.struct(F.lit(True).alias("own"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key"))
    listed = F.transform(keys, lambda k: F.struct(F.lit(False).alias("own"), k.alias("key")))
    cand = page.select("*", F.explode(F.concat(F.array(own), listed)).alias("c")).select("id", "host", "path", "part", "copies", "c.own", "c.key")
    cand = cand.select("*", _block(F.col("key"), blocks).alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(_bits(F.col("key")))])
    bits = bloom(rules, blocks)
    hit = cand.join(F.broadcast(bits) if blocks <= most_broadcast else bits, "block", "left").where(
        " and ".join(f"(w{i} & m{i}) = m{i}" for i in range(WORDS)) + " or own"
    )
    won = hit.select("id", "host", "path", "part", "copies", "own", "key").join(rules.withColumn("own", F.lit(False)), ["own", "key"], "left")
    best = won.groupBy("id", "host", "path", "part").agg(
        F.max("copies").alias("copies"),
        F.max(F.when(F.col("verdict").isNotNull(), F.struct(F.length("key").alias("l"), "hl", "key", "verdict"))).alias("r"),
    )
    # copies come back in two steps, so that no array is longer than the root of their number
    row = F.ceil(F.sqrt("copies"))
    rows = best.select("*", row.alias("w"), F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("copies") / row) - 1)).alias("i"))
    return rows.select(
        F.col("id").alias(id_col), "host", "path", F.col("r.key").alias("rule"), F.coalesce(F.col("r.verdict"), F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.least("w", F.col("copies") - F.col("i") * F.col("w")))).alias("_copy"),
    ).drop("_copy")
