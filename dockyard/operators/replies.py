"""Send results: the outbound queue and the service's replies.

The HTTP exchange itself is not part of this library; replies arrive as a
table (unique_id, response_xml, ms_elapsed, attempts), e.g. written by the
sender. Every step is a set operation over all messages of the batch; the
retry loop lives in the caller, driven by :func:`retry_plan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.functions.columns import as_of_lit

DEFAULT_MAX_RETRIES = 5

# One schema for both reply shapes: a (namespaced) result element under the
# root, or a root <error> with a <message>. The corrupt-record column must be
# the last field.
REPLY_SCHEMA = ("result struct<resultType: string, errorCode: string, message: string>, "
                "message string, _corrupt_record string")
XML_OPTS = {"ignoreNamespace": "true", "columnNameOfCorruptRecord": "_corrupt_record"}


def root_name(xml) -> Column:
    """Local name of the document's root element ('' when there is none)."""
    col = F.col(xml) if isinstance(xml, str) else xml
    return F.regexp_extract(col, r"<(?:[A-Za-z_][\w.-]*:)?([A-Za-z_][\w.-]*)", 1)


def result_node(xml, parsed: Column, malformed: Column) -> Column:
    """The last ``result`` element at any depth as a struct.

    The usual place, a single one under the root, is in the parsed document;
    only other documents are searched by XPath (prefixes are dropped first:
    the XPath functions don't know namespaces)."""
    col = F.col(xml) if isinstance(xml, str) else xml
    # the expression runs over the few documents that hold the word at all
    n = F.when(F.contains(col, F.lit("result")), F.regexp_count(col, F.lit(r"<(?:[A-Za-z_][\w.-]*:)?result[\s/>]"))).otherwise(
        F.when(col.isNotNull(), F.lit(0)))
    plain = F.regexp_replace(col, r"(</?)[A-Za-z_][\w.-]*:", "$1")
    last = "(//result)[last()]"

    def part(name: str) -> Column:
        return F.when(F.xpath_boolean(plain, F.lit(f"boolean({last}/{name})")),
                      F.xpath_string(plain, F.lit(f"{last}/{name}")))

    searched = F.struct(part("resultType").alias("resultType"), part("errorCode").alias("errorCode"),
                        part("message").alias("message"))
    return F.when(malformed | (n == 0), F.lit(None)).when((n > 1) | parsed.isNull(), searched).otherwise(parsed)


def parse_replies(replies: DataFrame, col: str = "response_xml") -> DataFrame:
    """Adds ``_reply`` (parsed struct), ``_root`` (root element name) and
    ``_result`` (the result element, at any depth)."""
    p = (replies.withColumn("_reply", F.from_xml(F.col(col), REPLY_SCHEMA, XML_OPTS))
         .withColumn("_root", root_name(col)))
    bad = F.coalesce(F.col("_reply._corrupt_record").isNotNull(), F.lit(False))
    return p.withColumn("_result", result_node(col, F.col("_reply.result"), bad))


def _protocol_error() -> Column:
    return F.when(F.col("_root") == "error", F.left(F.col("_reply.message"), F.lit(500)))


def _result_error() -> Column:
    r = F.col("_result")
    return F.when(F.lower(r["resultType"]) == "failure", F.concat(r["errorCode"], F.lit(":"), r["message"]))


def pending_messages(queue: DataFrame) -> DataFrame:
    """Messages waiting to be sent (status 0)."""
    return queue.filter(F.col("queue_status") == 0)


def pallet_resend(queue: DataFrame) -> DataFrame:
    """New queue version: a failed addPalletRequest that was never retried is
    turned into an updatePalletRequest and queued again (status 0, retries 1,
    reply fields cleared). Any error qualifies. The document is rewritten
    only when its root is addPalletRequest."""
    hit = ((F.coalesce(F.col("error_msg"), F.lit("")) != "")
           & (F.col("message_type") == "addPalletRequest") & (F.col("retries") == 0))
    queue = queue.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    hit = F.col("_hit")  # decided once, before the fields it reads are cleared
    xml = F.col("message_xml")
    rewritten = F.replace(F.replace(xml, F.lit("<addPalletRequest"), F.lit("<updatePalletRequest")),
                          F.lit("</addPalletRequest>"), F.lit("</updatePalletRequest>"))
    cols = [c for c in queue.columns if c != "_hit"]
    out = (queue
           .withColumn("message_xml", F.when(hit & (root_name(xml) == "addPalletRequest"), rewritten)
                       .otherwise(xml))
           .withColumn("queue_status", F.when(hit, F.lit(0)).otherwise(F.col("queue_status")))
           .withColumn("dt_processed", F.when(hit, F.lit(None)).otherwise(F.col("dt_processed")))
           .withColumn("response_xml", F.when(hit, F.lit(None)).otherwise(F.col("response_xml")))
           .withColumn("error_msg", F.when(hit, F.lit(None)).otherwise(F.col("error_msg")))
           .withColumn("retries", F.when(hit, F.lit(1)).otherwise(F.col("retries")))
           .withColumn("message_type", F.when(hit, F.lit("updatePalletRequest"))
                       .otherwise(F.col("message_type"))))
    return out.select(*cols)


def protocol_errors(replies: DataFrame) -> DataFrame:
    """Root error/message of each reply, cut to 500 characters (NULL when the
    root is not ``error``)."""
    return parse_replies(replies).select("unique_id", _protocol_error().alias("protocol_error"))


def retry_plan(queue: DataFrame, replies: DataFrame, max_retries: int = DEFAULT_MAX_RETRIES) -> DataFrame:
    """Messages to send again: the reply is a protocol error and the message
    has been retried fewer than ``max_retries`` times."""
    pe = protocol_errors(replies).filter(F.coalesce(F.col("protocol_error"), F.lit("")) != "")
    q = queue.select("unique_id", F.coalesce(F.col("retries"), F.lit(0)).alias("_r"))
    return (pe.join(q, "unique_id")
            .filter(F.col("_r") < max_retries)
            .select("unique_id", (F.col("_r") + 1).alias("next_retries"), "protocol_error"))


def reply_result(replies: DataFrame) -> DataFrame:
    """code:message when the result type is failure (any case), else NULL;
    NULL as well when either part is NULL (T-SQL ``+``)."""
    r = F.col("_result")
    return parse_replies(replies).select("unique_id", r["resultType"].alias("result_type"),
                                         r["errorCode"].alias("error_code"),
                                         _result_error().alias("error_msg"))


def message_status(queue: DataFrame, replies: DataFrame, as_of=None) -> DataFrame:
    """New queue version for the replied messages: status 2 when the reply has
    no failure result, else 3; reply, elapsed ms, retries and time.

    K2: as in the reference a protocol error left after the retries does not
    make the status 3 (the result check overwrites it); it is kept in the
    extra ``protocol_error`` column."""
    # one parse of each reply, one join to the queue
    rp = parse_replies(replies).select(
        "unique_id", F.col("response_xml").alias("_resp"), "ms_elapsed",
        (F.col("attempts") - 1).alias("_retries"), _result_error().alias("_err"),
        _protocol_error().alias("protocol_error"), F.lit(True).alias("_hit"))
    j = queue.join(rp, "unique_id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    cols = [c for c in queue.columns]
    out = (j.withColumn("queue_status", F.when(hit, F.when(F.coalesce(F.col("_err"), F.lit("")) == "",
                                                           F.lit(2)).otherwise(F.lit(3)))
                        .otherwise(F.col("queue_status")))
           .withColumn("response_xml", F.when(hit, F.col("_resp")).otherwise(F.col("response_xml")))
           .withColumn("error_msg", F.when(hit, F.col("_err")).otherwise(F.col("error_msg")))
           .withColumn("retries", F.when(hit, F.col("_retries")).otherwise(F.col("retries")))
           .withColumn("dt_processed", F.when(hit, as_of_lit(as_of)).otherwise(F.col("dt_processed"))))
    keep = cols + [c for c in ("ms_elapsed", "protocol_error") if c not in cols]
    if "ms_elapsed" in cols:
        out = out.withColumn("ms_elapsed", F.col("ms_elapsed"))
    return out.select(*keep)
