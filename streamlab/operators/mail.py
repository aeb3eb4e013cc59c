"""Mail archive jobs: counts, reply graph, member of the month, term statistics, archive parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.functions import text as tx
from streamlab.plans.hotkeys import PART_ROWS, hot_keys_of, salted_join
from streamlab.plans.once import once
from streamlab.schemas import MAIL_COLUMNS, MAIL_TIME_FORMAT

# Addresses of bots.
REPLY_GRAPH_BOTS = ["git@git.apache.org", "jira@apache.org"]
MEMBER_BOTS = ["jira@apache.org", "no-reply@apache.org", "git@git.apache.org"]


def exclude_senders(df: DataFrame, addresses: list[str], column: str = "email") -> DataFrame:
    return df.filter(~F.col(column).isin(addresses))


def month_email(mails: DataFrame) -> DataFrame:
    return mails.select(
        tx.month(F.col("time")).alias("month"), tx.email_address(F.col("sender")).alias("email")
    )


def mail_count(mails: DataFrame) -> DataFrame:
    return month_email(mails).groupBy("month", "email").agg(F.count(F.lit(1)).alias("cnt"))


def reply_connections(mails: DataFrame, bots: list[str] | None = None) -> DataFrame:
    """``(replier, author, cnt)`` per replied message.

    Both sides are counted per (message, address) before they meet, so a message with very many
    replies, or the 'null' that stands for no reply, is a short list of addresses by then.
    """
    known = mails.select(
        "messageId", "replyTo", tx.email_address(F.col("sender")).alias("email")
    )
    known = exclude_senders(known, REPLY_GRAPH_BOTS if bots is None else bots)
    replies = known.groupBy("replyTo", "email").agg(F.count(F.lit(1)).alias("_replies"))
    originals = known.groupBy("messageId", "email").agg(F.count(F.lit(1)).alias("_copies"))
    return replies.select(
        F.col("replyTo").alias("messageId"), F.col("email").alias("replier"), "_replies"
    ).join(originals.withColumnRenamed("email", "author"), "messageId").select(
        "messageId",
        "replier",
        "author",
        (F.col("_replies") * F.col("_copies")).alias("cnt"),
    )


def reply_graph(mails: DataFrame, bots: list[str] | None = None) -> DataFrame:
    """How often each address replied to each other address."""
    return (
        reply_connections(mails, bots)
        .groupBy("replier", "author")
        .agg(F.sum("cnt").alias("cnt"))
    )


def member_of_month(mails: DataFrame, bots: list[str] | None = None) -> DataFrame:
    """The address(es) with the most mails of each month; ties give several rows."""
    counts = exclude_senders(month_email(mails), MEMBER_BOTS if bots is None else bots)
    counts = counts.groupBy("month", "email").agg(F.count(F.lit(1)).alias("cnt"))
    best = counts.groupBy("month").agg(F.max("cnt").alias("cnt"))
    return counts.join(best, ["month", "cnt"]).select("month", "email", "cnt")


# --- term statistics -----------------------------------------------------------------------------


def _stop(stop_words: list[str] | None) -> list[str]:
    return tx.STOP_WORDS if stop_words is None else stop_words


def term_frequency(
    docs: DataFrame, id_col: str, text_col: str, stop_words: list[str] | None = None
) -> DataFrame:
    """``(id, word, tf)``. One document is one row, so its words are counted inside the row: sorted,
    cut into runs of equal words, and no word crosses the network before it is counted."""
    words = F.sort_array(tx.words(F.col(text_col)))
    starts = F.filter(
        F.sequence(F.lit(1), F.size("_w")),
        lambda i: (i == 1) | (F.get("_w", i - 1) != F.get("_w", i - 2)),
    )
    runs = F.arrays_zip(
        F.col("_at").alias("at"),
        F.concat(F.expr("slice(_at, 2, size(_at))"), F.array(F.size("_w") + 1)).alias("to"),
    )
    counted = (
        docs.select(id_col, once(words).alias("_w"))
        .filter(F.size("_w") > 0)
        .select(id_col, "_w", once(starts).alias("_at"))
        .select(id_col, "_w", F.explode(runs).alias("_run"))
        .select(
            id_col,
            F.get("_w", F.col("_run.at") - 1).alias("word"),
            (F.col("_run.to") - F.col("_run.at")).cast("long").alias("tf"),
        )
    )
    return counted.filter(~F.col("word").isin(_stop(stop_words)))


def document_frequency(
    docs: DataFrame, text_col: str, stop_words: list[str] | None = None
) -> DataFrame:
    """``(word, df)``: in how many documents each word occurs."""
    stop = F.array(*[F.lit(w) for w in _stop(stop_words)]).cast("array<string>")
    words = F.array_except(tx.words(F.col(text_col)), stop)
    return (
        docs.select(F.explode(words).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def tf_idf(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    stop_words: list[str] | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``(id, word, tfidf)`` with ``tf * (N / df)``.

    Words are counted per document by one combined aggregate; df is counted from its rows, so the texts
    are read once and the shuffle is used twice. The word join is broadcast or not by the size of
    the vocabulary at run time; hot words are read off df and salted.
    """
    words = docs.select(id_col, F.explode(tx.words(F.col(text_col))).alias("word"))
    words = words.filter(~F.col("word").isin(_stop(stop_words)))
    tf = words.groupBy(id_col, "word").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    hot = hot_keys_of(df, ["word"], "df", part_rows)
    documents = docs.select(F.count(F.lit(1)).alias("n")).scalar()
    weighted = salted_join(tf, df, ["word"], [id_col], part_rows=part_rows, hot=hot)
    return weighted.select(
        id_col, "word", tx.tf_idf_weight(F.col("tf"), F.col("df"), documents).alias("tfidf")
    )


# --- archive parsing -----------------------------------------------------------------------------

# Delimiters of mail records and fields, and the sender prefix of the archive.
FIELD_DELIMITER = "#|#"
RECORD_DELIMITER = "##//##"
ARCHIVE_PREFIX = "From dev-return"

# Just before the first line that holds nothing but white space. Only "\\n" ends a line.
_BODY_START = "(?dm)(?=^[\\x00-\\x09\\x0B-\\x20]*$)"
_BLANK_FIRST_LINE = "\\A[\\x00-\\x09\\x0B-\\x20]*(\\n|\\z)"


def parse_mails(raw: DataFrame, column: str = "value", prefix: str = ARCHIVE_PREFIX) -> DataFrame:
    """Raw mail texts to the six mail fields. Mails that lack a field, or hold a delimiter in one,
    are dropped."""
    # Line breaks at the very end do not make lines.
    text = F.regexp_replace(F.col(column), "\\n+$", "")
    halves = (
        raw.select(once(F.split(text, _BODY_START, 2)).alias("_half"))
        .filter(F.size("_half") == 2)
        .select(F.col("_half")[0].alias("_head"), F.col("_half")[1].alias("_rest"))
        .filter(~F.col("_head").rlike(_BLANK_FIRST_LINE))
        .select(once(F.split("_head", "\\n")).alias("_headers"), "_rest")
    )
    fields = {
        "messageId": "message-id: ",
        "sender": "from: ",
        "subject": "subject: ",
        "replyTo": "in-reply-to: ",
    }

    def found(name: str) -> Column:
        matching = F.filter("_headers", lambda line: F.lower(line).startswith(name))
        return F.transform(matching, lambda line: F.substring(line, len(name) + 1, 1 << 30))

    def clean(c: Column) -> Column:
        return ~c.contains(FIELD_DELIMITER) & ~c.contains(RECORD_DELIMITER)

    first = F.try_element_at(F.filter("_headers", lambda line: line.startswith(prefix)), F.lit(-1))
    stamp = F.when(F.length(first) >= 24, F.regexp_replace(F.substring(first, -24, 24), "\\s+", " "))
    when = F.try_to_timestamp(F.regexp_replace(stamp, "^ ?\\S+ ", ""), F.lit("MMM d HH:mm:ss yyyy"))
    body = F.regexp_replace(F.concat("_rest", F.lit("\n")), "=\\n", "")
    parsed = halves.select(
        once(
            F.struct(
                F.date_format(when, MAIL_TIME_FORMAT).alias("time"),
                body.alias("body"),
                *[found(start).alias(name) for name, start in fields.items()],
            )
        ).alias("m")
    ).select("m.*")
    valid = clean(F.col("body"))
    for name in fields:
        valid = valid & F.forall(name, clean)
    last = {name: F.try_element_at(name, F.lit(-1)) for name in fields}
    last["replyTo"] = F.coalesce(last["replyTo"], F.lit("null"))
    return (
        parsed.filter(valid)
        .select(*[last.get(c, F.col(c)).alias(c) for c in MAIL_COLUMNS])
        .filter(" AND ".join(f"{c} IS NOT NULL" for c in MAIL_COLUMNS))
    )


def distinct_mails(mails: DataFrame) -> DataFrame:
    """One mail per messageId: the earliest, then the one with the smallest text."""
    rest = ["time", "body", "sender", "subject", "replyTo"]
    first = F.min(F.struct(*rest)).alias("m")
    return mails.groupBy("messageId").agg(first).select(
        "messageId", *[F.col(f"m.{c}") for c in MAIL_COLUMNS[1:]]
    )


def mbox_to_mails(raw: DataFrame, column: str = "value") -> DataFrame:
    return distinct_mails(parse_mails(raw, column))
