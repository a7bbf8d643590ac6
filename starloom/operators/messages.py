"""Message stores: filters, recency, deduplication, unseen rows and routing.

A message table carries an explicit order column ``seq``; nothing relies on the
physical order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.operators.ordering import number_in_groups
from starloom.session import small_side

ALL_RECIPIENTS = "<all>"


def by_role(messages: DataFrame, role: str) -> DataFrame:
    return messages.filter(F.col("role") == role)


def by_content(messages: DataFrame, text: str) -> DataFrame:
    return messages.filter(F.col("content").contains(text))


def by_actions(messages: DataFrame, actions: list[str]) -> DataFrame:
    return messages.filter(F.col("cause_by").isin(list(actions)))


def latest(messages: DataFrame, k: int, seq: str = "seq") -> DataFrame:
    """The k rows with the highest sequence, all of them for k = 0."""
    return messages if k == 0 else messages.orderBy(F.col(seq).desc()).limit(k)


def latest_per(messages: DataFrame, key: str, k: int, seq: str = "seq") -> DataFrame:
    """The k latest rows of each group; the rank filter is applied before the shuffle as well."""
    if k == 0:
        return messages
    w = Window.partitionBy(key).orderBy(F.col(seq).desc())
    return messages.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")


def older_than_latest(messages: DataFrame, key: str, k: int, seq: str = "seq") -> DataFrame:
    """Rows before the k latest of their group: those that move to the long-term store.

    Only the group's k-th latest sequence is needed, so no group is collected.
    """
    edge = latest_per(messages.select(key, seq), key, k, seq).groupBy(key).agg(F.min(seq).alias("__edge"))
    return messages.join(small_side(edge), key).filter(F.col(seq) < F.col("__edge")).drop("__edge")


def latest_of_kind(messages: DataFrame, kind: str, seq: str = "seq") -> DataFrame:
    """The content of the newest row of each kind."""
    return messages.groupBy(kind).agg(F.max_by("content", seq).alias("content"), F.max(seq).alias(seq))


def first_occurrences(messages: DataFrame, identity: list[str], seq: str = "seq") -> DataFrame:
    """Drop rows equal on ``identity``, keeping the first; leave the id out to ignore it.

    A minimum by sequence combines on the map side, so a message copied a
    billion times still reaches the reducer as one row per task.
    """
    others = [c for c in messages.columns if c not in identity]
    kept = F.min_by(F.struct(*others), F.col(seq))
    grouped = messages.groupBy(*identity).agg(kept.alias("__first"))
    return grouped.select(*identity, "__first.*").select(*messages.columns)


def unseen(observed: DataFrame, stored: DataFrame, identity: list[str], k: int = 0, seq: str = "seq") -> DataFrame:
    """Observed rows that are not among the k latest stored rows (all for k = 0)."""
    known = latest(stored, k, seq).select(*[F.col(c).alias(f"__{c}") for c in identity]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in identity]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return observed.join(known, condition, "left_anti")


def routes(messages: DataFrame, recipients: DataFrame, message_id: str, recipient: str) -> DataFrame:
    """(message, recipient) pairs whose address sets meet; a broadcast is one row to ``<all>``.

    ``messages`` has ``send_to``, ``recipients`` has ``addresses``, both arrays.
    Addresses meet by equality.  A broadcast reaches everyone by definition, so
    it is not written once per recipient; ``mailbox_sizes`` counts it for each.
    """
    loud = messages.filter(F.array_contains("send_to", ALL_RECIPIENTS))
    sent = messages.filter(~F.array_contains("send_to", ALL_RECIPIENTS)).select(
        message_id, F.explode(F.array_distinct("send_to")).alias("address"))
    homes = recipients.select(recipient, F.explode(F.array_distinct("addresses")).alias("address"))
    direct = sent.join(homes, "address").select(message_id, recipient).distinct()
    return direct.unionByName(loud.select(message_id, F.lit(ALL_RECIPIENTS).alias(recipient)))


def mailbox_sizes(routed: DataFrame, recipients: DataFrame, recipient: str) -> DataFrame:
    """Messages reaching each recipient: the direct ones and every broadcast."""
    broadcasts = routed.filter(F.col(recipient) == ALL_RECIPIENTS).count()
    direct = routed.filter(F.col(recipient) != ALL_RECIPIENTS).groupBy(recipient).agg(F.count(F.lit(1)).alias("__n"))
    counted = recipients.select(recipient).join(direct, recipient, "left")
    return counted.select(recipient, (F.coalesce("__n", F.lit(0)) + F.lit(broadcasts)).alias("messages"))


def unrouted(messages: DataFrame, recipients: DataFrame, message_id: str) -> DataFrame:
    """Messages none of whose addresses belongs to a recipient."""
    homes = recipients.select(F.explode("addresses").alias("address")).distinct()
    sent = messages.select(message_id, F.explode("send_to").alias("address"))
    reached = sent.join(homes, "address", "left_semi").unionByName(sent.filter(F.col("address") == ALL_RECIPIENTS))
    return messages.join(reached.select(message_id).distinct(), message_id, "left_anti")


def keyword_postings(records: DataFrame, record_id: str, keywords: str, seq: str) -> DataFrame:
    """Inverted keyword index: one row per (keyword, record), read newest first by ``seq``.

    Kept as rows, not as one list per keyword: a keyword in a third of all
    records would make a list no task can hold.
    """
    return records.select(F.explode(F.array_distinct(F.transform(keywords, F.lower))).alias("keyword"), record_id, seq)


def ranked_postings(postings: DataFrame, record_id: str, seq: str) -> DataFrame:
    """Postings with their position in the keyword's newest-first list, also for a keyword most records share."""
    return number_in_groups(postings, ["keyword"], [F.col(seq).desc(), F.col(record_id).desc()], "position")


def last_by_keyword(postings: DataFrame, record_id: str, seq: str) -> DataFrame:
    """Newest record of each keyword and the number of records holding it."""
    return postings.groupBy("keyword").agg(
        F.max_by(record_id, F.struct(seq, record_id)).alias(f"last_{record_id}"), F.count(F.lit(1)).alias("records")
    )


def relevant(records: DataFrame, postings: DataFrame, record_id: str, contents: list[str]) -> DataFrame:
    """Records holding any of the contents as a keyword; both sides are lower-cased."""
    hits = postings.filter(F.col("keyword").isin([c.lower() for c in contents])).select(record_id).distinct()
    return records.join(hits, record_id, "left_semi")


def keyword_strength(records: DataFrame, keywords: str, predicate: str, object_: str) -> DataFrame:
    """Keyword counts over records other than those stating "is idle"."""
    busy = records.filter(F.concat_ws(" ", predicate, object_) != "is idle")
    return busy.select(F.explode(F.transform(keywords, F.lower)).alias("keyword")).groupBy("keyword").agg(
        F.count(F.lit(1)).alias("strength")
    )


def latest_summaries(records: DataFrame, n: int, seq: str, summary: Column) -> DataFrame:
    """Distinct summaries among the n newest records."""
    return latest(records, n, seq).select(summary.alias("summary")).distinct()


def vote_winner(votes: DataFrame, key: str, choice: str, order: str) -> DataFrame:
    """Most voted choice per group; blanks do not count and a tie goes to the choice voted first."""
    cast = votes.filter(F.col(choice).isNotNull() & (F.col(choice) != ""))
    tally = cast.groupBy(key, choice).agg(F.count(F.lit(1)).alias("votes"), F.min(order).alias("first_vote"))
    return tally.groupBy(key).agg(
        F.max_by(choice, F.struct("votes", -F.col("first_vote"))).alias("winner"), F.max("votes").alias("votes")
    )


def majority(verdicts: DataFrame, key: str, verdict: str) -> DataFrame:
    """True where more verdicts hold than fail; a tie is false."""
    return verdicts.groupBy(key).agg((F.count_if(F.col(verdict)) > F.count_if(~F.col(verdict))).alias("accepted"))
