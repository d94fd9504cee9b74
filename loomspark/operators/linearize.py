"""Message graphs to threads: projection, walk from the current leaf to the root, filters, file names."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import jsonx, text
from .order import nth_of


def best_leaf(mapping: Column) -> Column:
    """Id of the latest node with a message and no children; of equally late ones the greatest id."""
    nodes = F.filter(F.map_entries(mapping), lambda e: e.value.message.isNotNull() & (F.coalesce(F.size(e.value.children), F.lit(0)) <= 0))
    ranked = F.transform(nodes, lambda e: F.struct(F.coalesce(e.value.message.create_time, F.lit(0.0)).alias("t"), e.key.alias("id")))
    return F.array_max(ranked).id


_WALKED = T.StructType([T.StructField("path", T.ArrayType(T.IntegerType())), T.StructField("err", T.StringType())])


def _paths(keys: pa.Array, parents: pa.Array, leaves: pa.Array) -> pa.Array:
    out = []
    for own, above, leaf in zip(keys, parents, leaves, strict=True):
        place = {k: i for i, k in enumerate(own.as_py() or ())}
        above = above.as_py() or ()
        path, seen, err, now = [], set(), None, leaf.as_py()
        while now:
            i = place.get(now)
            if i is None:
                err = "missing node"
                break
            if i in seen:
                err = "cycle"
                break
            seen.add(i)
            path.append(i)
            now = above[i]
        out.append({"path": path[::-1], "err": err})
    return pa.array(out, pa.struct([("path", pa.list_(pa.int32())), ("err", pa.string())]))


def walk(mapping: Column, leaf: Column) -> Column:
    """struct(path, err): places in the mapping from the root to leaf; err says 'missing node' or 'cycle', else is null.

    Nodes are looked up by a dictionary of each row, in Arrow batches of ids alone, so a thread of n
    nodes takes n steps.
    """
    return F.arrow_udf(_paths, _WALKED)(F.map_keys(mapping), F.transform(F.map_values(mapping), lambda n: n.parent), leaf)


def message(raw: Column) -> Column:
    """A raw message as the thread's message struct, null if one of the three drop rules holds."""
    role = F.coalesce(F.nullif(text.trim(raw.author.role), F.lit("")), F.lit("unknown"))

    def own(c: Column) -> Column:
        no_text = text.blank(c["text"])
        drop = (
            ((role == "system") & no_text & jsonx.hidden(raw.metadata))
            | ((role == "tool") & no_text & text.blank(c["title"]) & text.blank(c["url"]) & jsonx.image_like(c["content_type"]))
            | (no_text & (c["content_type"] == "") & (c["url"] == "") & (c["title"] == ""))
        )
        fields = F.struct(
            role.alias("role"), F.coalesce(text.trim(raw.author["name"]), F.lit("")).alias("name"), raw.create_time.alias("create_time"),
            *(c[k].alias(k) for k in ("content_type", "text", "domain", "title", "url")),
        )
        return F.when(~drop, fields)

    return F.when(raw.isNotNull(), jsonx.once(jsonx.content(raw.content), own))


def project(raw: DataFrame) -> DataFrame:
    """Conversations with their id: conversation_id, else id; err is set where both are blank."""
    own = F.coalesce(F.nullif("conversation_id", F.lit("")), F.nullif("id", F.lit("")))
    return raw.withColumn("conversation_id", own).withColumn("err", F.when(own.isNull(), F.lit("no id")))


def threads(raw: DataFrame) -> DataFrame:
    """One thread for each raw conversation; err names what is wrong with rows to quarantine, else is null. Its place in an archive stays."""
    mapping = F.col("mapping")
    leaf = F.coalesce(F.nullif("current_node", F.lit("")), best_leaf(mapping))
    walked = project(raw).withColumn("_walk", F.when(F.size(mapping) > 0, walk(mapping, leaf)))
    found = F.filter(F.transform(F.col("_walk.path"), lambda i: message(F.get(F.map_values(mapping), i).message)), lambda m: m.isNotNull())
    return walked.select(
        "conversation_id", F.coalesce("title", F.lit("")).alias("title"), "create_time", "update_time",
        F.when(F.col("_walk.err").isNull(), found).alias("messages"), F.coalesce("err", F.col("_walk.err")).alias("err"),
        *(c for c in ("_file", "_place") if c in raw.columns),
    )


def good(found: DataFrame, strict: bool = False) -> DataFrame:
    """Threads without an error; strict: any error fails the query."""
    if strict:
        err = F.assert_true(F.col("err").isNull(), F.concat(F.lit("bad conversation: "), F.coalesce("conversation_id", F.lit("?")), F.lit(": "), F.col("err")))
        found = found.filter(err.isNull())
    return found.filter("err IS NULL").drop("err")


def quarantine(found: DataFrame) -> DataFrame:
    return found.filter("err IS NOT NULL").select("conversation_id", "err")


def numbered_names(rows: DataFrame, raw: str, order: str, name: str = "file_name") -> DataFrame:
    """Sanitised file names; the n-th repeat of a name gets -n, blank ones are 'thread'. One name may stand for all rows."""
    base = F.coalesce(F.nullif(text.file_component(raw), F.lit("")), F.lit("thread"))
    found = nth_of(rows, base, [F.col(order)], "__nth")
    return found.withColumn(name, F.when(F.col("__nth") == 1, base).otherwise(F.concat(base, F.lit("-"), F.col("__nth").cast("string")))).drop("__nth")


def messages(threads_: DataFrame) -> DataFrame:
    """The working form: a row for each message, with its place."""
    return threads_.select("conversation_id", F.posexplode("messages").alias("msg_idx", "m")).select("conversation_id", "msg_idx", "m.*")
