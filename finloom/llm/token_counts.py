"""Token counts: rollups by source, language and tokenizer version, kept up to date from signed deltas.

A batch of changes is summed to one signed row per (source, lang, tokenizer) before anything is stored, so a source with a
third of all documents costs one row per task. Each attempt to commit writes to a folder of its own and then publishes a small
manifest under the batch's name, which fails where that name is taken: a batch that is sent again, by the same writer or another,
or whose writer died half way, leaves the totals as they should be. Totals are the sum of the deltas that manifests name, in
whatever order they came; compact() replaces them by one.

Defined results: a null source, language or tokenizer is a group of its own; a null count is 0; a null op is an insert, and an
op that is none of insert, delete, revise and move changes nothing; repeated rows count each time; a null text has no tokens;
texts are counted whole, however long; empty batches commit and add nothing; further columns are ignored.
"""

from __future__ import annotations

import base64
import uuid
from functools import lru_cache
from urllib.parse import quote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from finloom.llm.common import remove, settle, small_batches

KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, d_docs long, d_tokens long"


@lru_cache(maxsize=8)
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counter(paths: list[str], pattern: str):
    """A column function: text -> the number of tokens under each of the rank files."""

    @arrow_udf("array<long>")
    def count(texts: pa.Array) -> pa.Array:
        coders = [encoding(p, pattern).encode_ordinary for p in paths]
        return pa.array([[len(c(t)) for c in coders] for t in (x or "" for x in texts.to_pylist())], pa.list_(pa.int64()))

    return count


def counted(docs: DataFrame, tokenizers: dict[str, str], pattern: str, text: str = "text") -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens for each document and tokenizer version (name -> rank file on every node)."""
    small_batches(docs.sparkSession)
    names = list(tokenizers)
    counts = token_counter([tokenizers[n] for n in names], pattern)
    rows = docs.select("doc_id", "source", "lang", counts(F.col(text)).alias("n"))
    return rows.select("doc_id", "source", "lang", F.inline(F.arrays_zip(F.array(*map(F.lit, names)).alias("tokenizer"), F.col("n").alias("n_tokens"))))


def as_changes(rows: DataFrame, op: str) -> DataFrame:
    """Change rows that insert or delete each of the counted rows."""
    return rows.select("doc_id", *KEYS, F.lit(op).alias("op"), "n_tokens")


def as_revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Change rows that take counted documents from one state to another; doc_ids are unique and not null in either.

    A document in one of them only is deleted or inserted; one whose source or language changed is moved.
    """
    old = before.select("doc_id", "tokenizer", F.col("source").alias("old_source"), F.col("lang").alias("old_lang"), F.col("n_tokens").alias("old_tokens"), F.lit(True).alias("was"))
    both = old.join(after.withColumn("is", F.lit(True)), ["doc_id", "tokenizer"], "full")
    stays = F.col("source").eqNullSafe(F.col("old_source")) & F.col("lang").eqNullSafe(F.col("old_lang"))
    op = F.when(F.col("was").isNull(), "insert").when(F.col("is").isNull(), "delete").when(stays, "revise").otherwise("move")
    here = F.col("is").isNotNull()
    now = [F.when(here, F.col(c)).otherwise(F.col(f"old_{c}")).alias(c) for c in ("source", "lang")]
    return both.select("doc_id", *now, "tokenizer", op.alias("op"), F.when(here, F.col("n_tokens")).otherwise(F.col("old_tokens")).alias("n_tokens"), "old_tokens", "old_source", "old_lang")


def signed(changes: DataFrame) -> DataFrame:
    """Sum change rows (source, lang, tokenizer, op, n_tokens, old_tokens, old_source, old_lang) to signed deltas.

    delete takes n_tokens away; revise adds n_tokens - old_tokens and leaves the number of documents; move takes a document of
    old_tokens from old_source and old_lang to source and lang. The columns of what was need only be there for these two.
    """
    op = F.coalesce("op", F.lit("insert"))
    column = lambda name, kind: F.col(name) if name in changes.columns else F.lit(None).cast(kind)
    new, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce(column("old_tokens", "long"), F.lit(0))
    docs = F.when(op.isin("insert", "move"), 1).when(op == "delete", -1).otherwise(0)
    tokens = F.when(op.isin("insert", "move"), new).when(op == "delete", -new).when(op == "revise", new - old).otherwise(0)
    arrives = F.struct("source", "lang", "tokenizer", docs.cast("long").alias("docs"), tokens.cast("long").alias("tokens"))
    leaves = F.struct(column("old_source", "string").alias("source"), column("old_lang", "string").alias("lang"), "tokenizer", F.lit(-1).cast("long").alias("docs"), (-old).cast("long").alias("tokens"))
    rows = changes.select(F.inline(F.when(op == "move", F.array(arrives, leaves)).otherwise(F.array(arrives))))
    return rows.groupBy(*KEYS).agg(F.sum("docs").alias("d_docs"), F.sum("tokens").alias("d_tokens"))


class TokenRollup:
    """The committed deltas under one folder of a shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs_api = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._fs_api.Path(self.root).getFileSystem(self._conf)

    def _path(self, *parts: str):
        return self._fs_api.Path("/".join((self.root, *parts)))

    def _manifest(self, batch_id: str) -> str:
        return f"batch={quote(batch_id, safe='')}"

    def committed(self, batch_id: str) -> bool:
        return self._fs.exists(self._path("manifests", self._manifest(batch_id)))

    def _publish(self, name: str, lines: list[str]) -> bool:
        """Make a manifest appear whole, or not at all where there is one of that name."""
        draft = self._path("drafts", uuid.uuid4().hex)
        out = self._fs.create(draft, True)
        out.writeBytes("\n".join(lines))
        out.close()
        target = self._path("manifests", name)
        self._fs.mkdirs(target.getParent())
        context = self._fs_api.FileContext.getFileContext(draft.getFileSystem(self._conf).getUri(), self._conf)
        nothing = self.spark.sparkContext._gateway.new_array(getattr(self._fs_api, "Options$Rename"), 0)
        try:
            context.rename(draft, target, nothing)
        except Py4JJavaError:
            if not self._fs.exists(target):
                raise
            self._fs.delete(draft, False)
            return False
        return True

    def _store(self, deltas: DataFrame, name: str, replaced: list[str]) -> bool:
        attempt = uuid.uuid4().hex
        deltas.write.parquet(f"{self.root}/deltas/attempt={attempt}")
        if self._publish(name, [attempt, *replaced]):
            return True
        remove(self.spark, f"{self.root}/deltas/attempt={attempt}")
        return False

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch once. Returns False, and does nothing, if it is there already."""
        return not self.committed(batch_id) and self._store(signed(changes), self._manifest(batch_id), [])

    def _live(self) -> list[str]:
        """The attempts whose deltas count."""
        if not self._fs.exists(self._path("manifests")):
            return []
        files = [row.value.split("\n") for row in self.spark.read.text(f"{self.root}/manifests", wholetext=True).collect()]
        return sorted({lines[0] for lines in files} - {x for lines in files for x in lines[1:]})

    def deltas(self) -> DataFrame:
        live = self._live()
        if not live:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*(f"{self.root}/deltas/attempt={x}" for x in live))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over all committed batches; groups that came to nothing are left out."""
        summed = self.deltas().groupBy(*KEYS).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
        return summed.where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> bool:
        """Put one folder of sums in the place of all that count now; batches stay committed. One writer may compact at a time.

        False if there was nothing to do, or another compaction of the same folders came first.
        """
        live = self._live()
        if len(live) < 2:
            return False
        sums = self.deltas().groupBy(*KEYS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
        return self._store(sums, f"compact={uuid.uuid5(uuid.NAMESPACE_OID, ' '.join(live)).hex}", live)


#: What cleaning changes: runs of blanks, and white space at either end.
BLANKS, ENDS = r"[ \t]{2,}", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z"


def history(docs: DataFrame, labels: DataFrame, rollup: TokenRollup, tokenizers: dict[str, str], pattern: str) -> DataFrame:
    """Totals after a history of batches, some of them sent twice and not in order.

    All documents are inserted; those that cleaning their blanks changes are revised; those labelled toxic are deleted. Texts are
    read once, for the counts before and after; what is joined with the labels are counts.
    """
    small_batches(docs.sparkSession)
    names = list(tokenizers)
    count = token_counter([tokenizers[n] for n in names], pattern)
    clean = F.regexp_replace(F.regexp_replace("text", BLANKS, " "), ENDS, "")
    rows = docs.select("doc_id", "source", "lang", count(F.col("text")).alias("n"), (clean != F.col("text")).alias("changed"), count(F.when(clean != F.col("text"), clean)).alias("m"))
    each = F.arrays_zip(F.array(*map(F.lit, names)).alias("tokenizer"), F.col("n").alias("n_tokens"), F.col("m").alias("clean_tokens"))
    counts = settle(rows.select("doc_id", "source", "lang", F.coalesce("changed", F.lit(False)).alias("changed"), F.inline(each)), "token-counts")
    inserts = as_changes(counts, "insert")
    revised = counts.where("changed").select("doc_id", *KEYS, F.lit("revise").alias("op"), F.col("clean_tokens").alias("n_tokens"), F.col("n_tokens").alias("old_tokens"))
    toxic = labels.where("toxic = 1 and doc_id is not null").select("doc_id").distinct()
    now = counts.withColumn("n_tokens", F.when(F.col("changed"), F.col("clean_tokens")).otherwise(F.col("n_tokens")))
    deletes = as_changes(now.join(toxic, "doc_id", "left_semi"), "delete")
    for name, changes in (("deletes", deletes), ("inserts", inserts), ("deletes", deletes), ("revisions", revised), ("inserts", inserts)):
        rollup.commit(name, changes)
    rollup.compact()
    return rollup.totals()
