"""Versioned Parquet snapshots of an index.

Documents fall into buckets by a hash of their path, and a bucket is the unit of
rewriting: a version writes the tables of the buckets it touches, then one small
manifest row per bucket saying which version holds it. Readers take the newest
manifest, so they see whole versions only, and an update costs what it touches.
Within a bucket the postings lie in folders by language, field and a hash of the term, sorted by
term, so a lookup opens only the folders its terms fall into; a term found in a third of all
documents lies spread over all buckets. The list of watched roots is versioned with them.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexharbor.functions.text import path_bucket, term_slot
from lexharbor.operators import changes, maintain
from lexharbor.operators import postings as P
from lexharbor.operators.analysis import DEFAULT, Registry
from lexharbor.operators.prefixes import RAW, match_prefixes
from lexharbor.plans.index import Index, partial_fields, partial_terms
from lexharbor.session import BROADCAST_ROWS, materialize, settings
from lexharbor.sources import files
from lexharbor.sources import roots as root_list

DOC_COLUMNS = ["path", "lang", "title", "body"]
SCHEMAS = {
    "docs": "path string, lang string, title string, body string, v int, bucket int",
    "postings": "path string, len int, term string, tf int, first boolean, "
                "positions array<int>, v int, bucket int, lang string, field string, slot int",
    "terms": "term string, df long, ttf long, v int, bucket int, lang string, field string",
    "fields": "lang string, field string, n_docs long, sum_len long, v int, bucket int",
}
ROOTS = "seq long, path string"
MANIFEST = ("bucket int, data_v int, posted boolean, buckets int, splits int, slots int, "
            "roots_v int, batch_id long, v int")

# Text of a bucket, the unit of rewriting; of a task that writes some of one, whose postings take
# over 20 times that to sort; of a folder of terms.
BUCKET_BYTES, SPLIT_BYTES, SLOT_BYTES = 2 << 30, 16 << 20, 128 << 20
LEAST_BUCKETS = 8
# Folders a task writes side by side; the rest of one that meets more is sorted by folder.
OPEN_FOLDERS = 64
# A written table's shuffle files are dropped at once; a task reads little of a stored table, as
# postings carried over are sorted again, and small files count as little more than their bytes.
WRITING = {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FOLDERS,
           "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
           "spark.sql.files.maxPartitionBytes": SPLIT_BYTES // 2,
           "spark.sql.files.openCostInBytes": 256 << 10}
# Paths, as hashes of eight bytes, that may be broadcast to carry postings over.
CARRIED_ROWS = 4 * BROADCAST_ROWS

# which version holds each bucket, and whether any of its documents has a term
Held = dict[int, tuple[int, bool]]


@dataclass(frozen=True)
class State:
    """One version: where its buckets and roots are, and how its tables are dealt."""

    v: int = 0
    held: Held = field(default_factory=dict)
    buckets: int = LEAST_BUCKETS
    splits: int = 1
    slots: int = 1
    roots_v: int = 0
    batch_id: int = -1


class Snapshots:
    """The versions of one index under ``root``; one writer at a time.

    ``buckets``, ``splits`` (tasks that write a bucket) and ``slots`` (folders of terms in a
    bucket) are taken from the volume of text whenever everything is published anew, unless given.
    """

    def __init__(self, spark: SparkSession, root: str, registry: Registry = DEFAULT,
                 buckets: int | None = None, splits: int | None = None, slots: int | None = None,
                 exact_len: bool = False):
        self.spark, self.root, self.registry = spark, root.rstrip("/"), registry
        self.exact_len = exact_len
        self._asked = (buckets, splits, slots)

    # -- reading ---------------------------------------------------------------

    def _manifest(self) -> list:
        """Rows of the newest version: at most one per bucket, and a marker."""
        try:
            table = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return []
        newest = table.agg(F.max("v").alias("v"))
        return table.join(F.broadcast(newest), "v", "left_semi").collect()

    def state(self) -> State:
        rows = self._manifest()
        if not rows:
            return self._dealt(State(), 0)
        held = {r["bucket"]: (r["data_v"], r["posted"]) for r in rows if r["bucket"] >= 0}
        one = rows[0]
        return State(one["v"], held, one["buckets"], one["splits"], one["slots"], one["roots_v"],
                     one["batch_id"])

    def _dealt(self, state: State, text_bytes: int) -> State:
        """``state`` with buckets, splits and slots fit for so much text."""
        buckets, splits, slots = self._asked
        buckets = buckets or max(LEAST_BUCKETS, -(-text_bytes // BUCKET_BYTES))
        each = text_bytes // buckets
        return replace(state, buckets=buckets, splits=splits or max(1, -(-each // SPLIT_BYTES)),
                       slots=slots or max(1, -(-each // SLOT_BYTES)))

    def exists(self) -> bool:
        return bool(self._manifest())

    def _table(self, name: str, held: Held) -> DataFrame:
        base = f"{self.root}/{name}"
        paths = [f"{base}/v={v}/bucket={b}" for b, (v, posted) in sorted(held.items())
                 if posted or name == "docs"]
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return (self.spark.read.schema(SCHEMAS[name]).option("basePath", base)
                .parquet(*paths))

    def open(self) -> Index:
        """The newest version; later ones do not change what this index reads."""
        return self._index(self.state())

    def _index(self, state: State) -> Index:
        docs = self._table("docs", state.held)
        return Index(docs.select(*DOC_COLUMNS), self._table("postings", state.held),
                     self._table("terms", state.held), self._table("fields", state.held),
                     self.registry, self.exact_len, stored=True, by_bucket=docs,
                     buckets=state.buckets, slots=state.slots)

    def roots(self) -> DataFrame:
        """``roots(seq, path)`` of the newest version."""
        return self._roots(self.state())

    def _roots(self, state: State) -> DataFrame:
        if not state.roots_v:
            return self.spark.createDataFrame([], ROOTS)
        return self.spark.read.schema(ROOTS).parquet(f"{self.root}/roots/v={state.roots_v}")

    # -- writing ---------------------------------------------------------------

    def _write(self, docs: DataFrame, state: State, fresh: DataFrame | None = None,
               carried: DataFrame | None = None) -> Held:
        """Write all tables of ``docs`` as version ``state.v``; the buckets that got any rows.

        The text is shuffled by bucket (and split, for buckets too big for one task);
        postings are then built in place, also where stem rules or tables merge some of them,
        unless more terms change by tables than may be broadcast. A task sorts its postings by term
        and writes the folders side by side.
        ``carried`` are postings of documents already analysed: only ``fresh`` ones are then cut.
        """
        v, buckets, splits = state.v, state.buckets, state.splits

        def dealt(df: DataFrame, by: str) -> DataFrame:
            split = F.pmod(F.hash(by), F.lit(splits))
            return (df.withColumn("unit", (F.col("bucket") * splits + split).cast("int"))
                    .repartitionById(buckets * splits, "unit"))

        def place(df: DataFrame) -> DataFrame:
            return dealt(df.withColumn("bucket", path_bucket(F.col("path"), buckets)), "path")

        def save(df: DataFrame, name: str, *by: str) -> None:
            with settings(df.sparkSession, WRITING):
                df.write.mode("overwrite").partitionBy(*by).parquet(f"{self.root}/{name}/v={v}")

        save(place(docs.select(*DOC_COLUMNS)).drop("unit"), "docs", "bucket")
        stored = self._read_version("docs", v)
        parts = [] if carried is None else [carried]
        if carried is None or fresh is not None:
            texts = stored if carried is None else fresh
            known = P.known_terms(texts, self.registry) if self.registry.resolves() else None
            rows = P.postings(place(texts.select(*DOC_COLUMNS)), self.registry, "bucket", "unit",
                              known=known)
            if known is not None and P.shuffles(known, self.registry):
                # a join by term has taken the postings out of their units
                rows = place(rows)
            parts.append(rows.withColumn("slot", term_slot(F.col("term"), state.slots)))
        folders = ["bucket", "lang", "field", "slot"]
        columns = ["path", "len", "term", "tf", "first", "positions", *folders]
        rows = reduce(DataFrame.unionByName, [part.select(*columns) for part in parts])
        save(rows.sortWithinPartitions("term"), "postings", *folders)
        posted = self._read_version("postings", v)
        save(dealt(partial_terms(posted, "bucket"), "term").drop("unit")
             .sortWithinPartitions("bucket", "lang", "field", "term"),
             "terms", "bucket", "lang", "field")
        save(partial_fields(posted, "bucket").repartition("bucket"), "fields", "bucket")
        full = {r["bucket"] for r in self._read_version("fields", v)
                .select("bucket").distinct().collect()}
        return {r["bucket"]: (v, r["bucket"] in full)
                for r in stored.select("bucket").distinct().collect()}

    def _read_version(self, name: str, v: int) -> DataFrame:
        base = f"{self.root}/{name}"
        return (self.spark.read.schema(SCHEMAS[name]).option("basePath", base)
                .parquet(f"{base}/v={v}"))

    def _commit(self, state: State) -> Index:
        """Publish a version: from here on readers see it."""
        same = (state.buckets, state.splits, state.slots, state.roots_v, state.batch_id, state.v)
        rows = [(-1, -1, False, *same)]
        rows += [(b, data_v, posted, *same) for b, (data_v, posted) in sorted(state.held.items())]
        (self.spark.createDataFrame(rows, MANIFEST).coalesce(1)
         .write.mode("append").partitionBy("v").parquet(f"{self.root}/manifest"))
        return self._index(state)

    def _with_roots(self, state: State, roots: DataFrame | None) -> State:
        """``state``, whose version is new, with its list of roots written if there is one."""
        if roots is None:
            return state
        roots.select("seq", "path").coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/roots/v={state.v}")
        return replace(state, roots_v=state.v)

    def publish(self, docs: DataFrame, roots: DataFrame | None = None) -> Index:
        """Replace everything by ``docs``; creates the index if there is none.

        A path has one document: of rows that share one, the greatest is kept. Only the
        rows of such paths are gathered for that. The list of roots stays unless ``roots`` is given.
        """
        docs = docs.select(*DOC_COLUMNS)
        size = docs.agg(F.sum(F.octet_length("body"))).first()[0] or 0
        old = self.state()
        state = self._dealt(replace(old, v=old.v + 1), size)
        twice = materialize(maintain.repeated_paths(docs), "repeated")
        if not twice.isEmpty():
            several = maintain.one_per_path(docs.join(twice, "path", "left_semi"))
            docs = docs.join(twice, "path", "left_anti").unionByName(several)
        state = replace(state, held=self._write(docs, state))
        return self._commit(self._with_roots(state, roots))

    def _rewrite(self, touched: list[int], gone: DataFrame | None, fresh: DataFrame | None,
                 batch_id: int | None = None, roots: DataFrame | None = None,
                 joined: bool = False) -> Index:
        """New version without the documents at ``gone(path)`` and with the ``fresh`` ones.

        Only the ``touched`` buckets are read and written. A fresh document, of which there is one
        for each path, takes the place of the one there was; the texts of the others are not
        analysed anew, their postings are carried over. ``joined`` fresh ones are not stored yet.
        """
        old = self.state()
        state = replace(old, v=old.v + 1,
                        batch_id=old.batch_id if batch_id is None else batch_id)
        mine = {b: old.held[b] for b in touched if b in old.held}
        kept = {b: w for b, w in old.held.items() if b not in mine}
        written: Held = {}
        if touched:
            docs = self._table("docs", mine).select(*DOC_COLUMNS)
            paths = [df.select("path") for df in (gone, fresh) if df is not None]
            out = materialize(reduce(DataFrame.unionByName, paths).distinct(), "out")
            rest = docs.join(out, "path", "left_anti")
            carried = self._carried(mine, docs, rest, out)
            if joined and carried is not None:
                fresh = materialize(fresh.select(*DOC_COLUMNS), "fresh")
            written = self._write(rest if fresh is None else rest.unionByName(fresh.select(*DOC_COLUMNS)),
                                  state, fresh, carried)
        strays = sorted(set(written) - set(touched))
        if strays:
            raise RuntimeError(f"rows fell into buckets {strays[:5]} that were not read; "
                               "nothing was committed")
        return self._commit(self._with_roots(replace(state, held={**kept, **written}), roots))

    def _carried(self, held: Held, docs: DataFrame, rest: DataFrame,
                 out: DataFrame) -> DataFrame | None:
        """Stored postings of ``rest``, the documents that stay; ``None`` if they are to be cut anew.

        Of the paths that stay and those that go the fewer are broadcast as hashes, which decide if
        no path of the others has the same hash. Tables may have changed, so terms settled by
        them are looked up again.
        """
        if self.registry.tables is not None:
            return None
        named = F.xxhash64("path").alias("h")
        stay = materialize(rest.select("path"), "stay")
        go = materialize(docs.select("path").join(out, "path", "left_semi"), "go")
        n_stay, n_go = stay.count(), go.count()
        fewer, others = (stay, go) if n_stay < n_go else (go, stay)
        if not n_stay or min(n_stay, n_go) > CARRIED_ROWS:
            return None
        hashes = F.broadcast(fewer.select(named).distinct())
        if not others.select(named).join(hashes, "h", "left_semi").isEmpty():
            return None
        rows = self._table("postings", held).withColumn("h", F.xxhash64("path"))
        return rows.join(hashes, "h", "left_semi" if n_stay < n_go else "left_anti").drop("h", "v")

    def _buckets_of(self, paths: DataFrame) -> list[int]:
        """Distinct buckets of some paths: no more than the index has."""
        buckets = self.state().buckets
        found = paths.select(path_bucket(F.col("path"), buckets).alias("b")).distinct()
        return [r["b"] for r in found.collect()]

    def upsert(self, batch: DataFrame) -> Index:
        """Add or replace documents; of rows with one path the greatest counts.

        The batch is stored first, so buckets and rows come from one evaluation of it.
        """
        batch = materialize(maintain.one_per_path(batch.select(*DOC_COLUMNS)), "batch")
        return self._rewrite(self._buckets_of(batch), None, batch)

    def _under(self, prefixes: DataFrame, mode: str) -> DataFrame:
        return maintain.paths_under(self.open().docs, prefixes, mode)

    def remove(self, root: str, mode: str = RAW) -> Index:
        """Remove the documents under one root."""
        return self.remove_all(self.spark.createDataFrame([(root,)], "prefix string"), mode)

    def remove_all(self, prefixes: DataFrame, mode: str = RAW) -> Index:
        """Remove the documents under any of ``prefixes(prefix)``, as one version."""
        gone = materialize(self._under(prefixes, mode), "gone")
        return self._rewrite(self._buckets_of(gone), gone, None)

    def register(self, new: DataFrame, scan: DataFrame) -> Index:
        """Add ``new(path)`` to the list of roots and the scanned documents to the index.

        Both change in one version. Roots follow those known, in the order of ``seq`` if there is
        one, else of their paths; one that is listed already keeps its place.
        """
        known = self.roots()
        last = known.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
        order = F.struct(*[c for c in ("seq", "path") if c in new.columns])
        # roots are typed in by people: their list is small
        lines = new.groupBy("path").agg(F.min(order).alias("o")).orderBy("o").select("path").collect()
        after = self.spark.createDataFrame(
            [(last + 1 + i, r["path"]) for i, r in enumerate(lines)], ROOTS)
        roots = materialize(maintain.register_roots(known, after), "roots")
        batch = materialize(maintain.one_per_path(scan.select(*DOC_COLUMNS)), "batch")
        return self._rewrite(self._buckets_of(batch), None, batch, roots=roots)

    def unregister(self, gone: DataFrame, mode: str = RAW) -> Index:
        """Take ``gone(path)`` off the list of roots and remove the documents under them.

        Both change in one version; paths that are not listed do nothing, and need not exist.
        """
        listed = materialize(gone.select("path").distinct().join(self.roots(), "path", "left_semi"),
                             "listed")
        if listed.isEmpty():
            return self.open()
        prefixes = listed.withColumnRenamed("path", "prefix")
        left = materialize(self.roots().join(listed, "path", "left_anti"), "roots")
        under = materialize(self._under(prefixes, mode), "gone")
        return self._rewrite(self._buckets_of(under), under, None, roots=left)

    def reindex(self, scan: DataFrame, roots: DataFrame | None = None, mode: str = RAW) -> Index:
        """Replace what lies under the stored roots, or those given, by a fresh scan of them."""
        roots = self.roots() if roots is None else roots
        scan = materialize(maintain.one_per_path(scan.select(*DOC_COLUMNS)), "scan")
        prefixes = roots.select(F.col("path").alias("prefix"))
        under = materialize(self._under(prefixes, mode), "gone")
        return self._rewrite(self._buckets_of(under.unionByName(scan.select("path"))), under, scan)

    def reindex_files(self, roots: DataFrame | None = None, extractors=None,
                      profile: DataFrame | None = None,
                      mode: str = RAW) -> tuple[Index, DataFrame]:
        """Scan the files under all roots and replace what lies there; also ``errors(path, error)``
        of files that could not be read or whose text could not be taken.

        Every root is checked first: one that cannot be read fails the call before anything
        is changed.
        """
        roots = self.roots() if roots is None else roots
        paths = root_list.readable(self.spark, roots)
        if not paths:
            return self.open(), self.spark.createDataFrame([], "path string, error string")
        read = reduce(DataFrame.unionByName,
                      [files.read_files(self.spark, path, extractors) for path in paths])
        docs, errors = files.documents(read, profile)
        return self.reindex(docs, roots, mode), errors

    def reconcile(self, scan: DataFrame, batch_id: int | None = None,
                  roots: DataFrame | None = None) -> Index:
        """Bring the index level with a full scan, rewriting only buckets that differ."""
        scan = materialize(maintain.one_per_path(scan.select(*DOC_COLUMNS)), "scan")
        body = F.md5(F.concat_ws("\u0000", "lang", "title", "body")).alias("hash")
        docs = self.open().docs
        diff = materialize(changes.snapshot_diff(
            docs.select("path", body), scan.select("path", body), ["hash"]), "diff")
        fresh = scan.join(diff.filter(F.col("kind") != changes.DELETE), "path", "left_semi")
        gone = diff.filter(F.col("kind") == changes.DELETE)
        return self._rewrite(self._buckets_of(diff), gone, fresh, batch_id, roots, joined=True)

    def purge(self) -> Index:
        """A version without documents and without roots."""
        old = self.state()
        return self._commit(replace(old, v=old.v + 1, held={}, roots_v=0))

    def apply(self, events: DataFrame, mode: str = RAW, batch_id: int | None = None,
              watched: bool = False, scan=None) -> Index:
        """Fold ``events(seq, kind, path, lang, title, body)`` in, as one version.

        A ``batch_id`` not above the last one applied is a replay and changes nothing. If
        ``watched``, only events under the stored roots count, each root up to the event that
        deletes it or a folder above it; such roots leave the list in the same version. ``scan``
        gives the documents as they are now; it is called if the batch tells of an overflow, and
        then decides: what was lost is in it, and so is whatever the other events did.
        """
        state = self.state()
        if batch_id is not None and batch_id <= state.batch_id:
            return self._index(state)
        events = materialize(events, "events")
        lost = scan is not None and not events.filter(F.col("kind") == changes.OVERFLOW).isEmpty()
        roots = None
        if watched:
            known = self._roots(state)
            deaths = materialize(changes.deaths_of_roots(events, known), "deaths")
            events = materialize(changes.events_while_alive(events, known, deaths, mode), "live")
            if not deaths.isEmpty():
                roots = materialize(known.join(deaths, "path", "left_anti"), "roots")
        if lost:
            return self.reconcile(scan(), batch_id, roots)
        docs = self._index(state).docs
        written = events.filter(F.col("kind").isin(changes.CREATE, changes.MODIFY))
        removed = match_prefixes(docs.select("path"), changes.removals(events, mode), mode)
        paths = materialize(written.select("path").unionByName(removed.select("path")).distinct(),
                            "gone")
        live = materialize(changes.fold_changes(events, mode).select(*DOC_COLUMNS), "live")
        return self._rewrite(self._buckets_of(paths), paths, live, batch_id, roots)
