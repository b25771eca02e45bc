"""Spark build of the clinical tables from the driver tables.

Everything here is lazy DataFrame code.  The expensive table is ``events``;
it is turned into rows by a single ``inline`` generator (no join, no shuffle):
the stay an event falls into is a closed-form function of ``(user_id, ts)``
because the stay calendar is itself a rule of the recipe.  Events outside a
stay are kept, without stay and admission.  The small dimension tables (stays,
admissions, patients) come from one aggregation over the users, stored once.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.sources import fixture_spec as spec
from stayframe.session import ensure_checkpoint_dir
from stayframe.sources.staging import new_run_id, stage
from stayframe.sources.tables import read_table

_US_PER_DAY = 86_400 * 1_000_000
# Events that one task of the load step turns into rows and sorts (about 5 kB of rows each).
LOAD_EVENTS = 1 << 17


def _origin(u: Column) -> Column:
    """Stay-calendar origin of a subject: EPOCH + (u mod 24) hours."""
    return F.lit(spec.EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), (u % 24).cast("int")
    )


def _trunc_second(ts: Column) -> Column:
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts),
        F.second(ts).cast("decimal(8,6)"),
    )


class Tables:
    """Lazily derived clinical tables over one driver directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        self.run_id = new_run_id()

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def input_paths(self) -> list[str]:
        return [self.sf_dir]

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        """Store a dimension once, so that no later plan derives it from ``events`` again."""
        return stage(self.spark, df, f"dim_{name}", self.run_id) if self.materialize else df

    # -- events and the stay they fall into ------------------------------------
    @cached_property
    def patient_events(self) -> DataFrame:
        """Every event, with its stay and admission, or NULL ones outside a stay."""
        ev = self.raw("events").select("event_id", "ts", "user_id", "event_type", "value")
        u = F.col("user_id")
        since = F.timestamp_diff("MICROSECOND", _origin(u), F.col("ts"))
        k = F.floor(since / F.lit(spec.STAY_SPACING_DAYS * _US_PER_DAY))
        stay_len_days = F.lit(3) + (u * spec.ID_STRIDE + k) % 6
        in_stay = (
            (since >= 0)
            & (since - k * spec.STAY_SPACING_DAYS * _US_PER_DAY
               <= stay_len_days * _US_PER_DAY)
        )
        return ev.withColumn("k", k).withColumn("u", u).select(
            "event_id", "event_type", "value",
            u.alias("subject_id"),
            F.when(in_stay, F.expr(spec.STAY_RULES["hadm_id"])).alias("hadm_id"),
            F.when(in_stay, F.expr(spec.STAY_RULES["icustay_id"])).alias("icustay_id"),
            _trunc_second(F.col("ts")).alias("charttime"),
        )

    @cached_property
    def event_rows(self) -> DataFrame:
        """Rows of every derived event table in one long frame, tagged ``tbl``.

        One scan of ``events`` and one generator produce all of them; when
        materializing, the frame is stored once, partitioned by ``tbl`` and
        sorted by item id inside each file, so a table read is a partition-
        pruned scan and item filters prune row groups.  The events are dealt to
        tasks by number before they become rows: a split of a file may hold any
        number of them, and a task sorts all rows of its events.
        """
        structs = []
        for role in spec.ROLES:
            for j, row in enumerate(role.rows):
                structs.append(F.struct(
                    F.lit(role.table).alias("tbl"),
                    F.expr(role.where).alias("keep"),
                    (F.col("event_id") * 100 + spec.ROLE_NO[role.name] * 10 + j)
                    .alias("row_id"),
                    F.expr(row.itemid).cast("bigint").alias("itemid"),
                    F.expr(row.value).cast("string").alias("value"),
                    F.expr(row.valuenum).cast("double").alias("valuenum"),
                ))
        events = self.patient_events
        if self.materialize:
            tasks = max(self.spark.sparkContext.defaultParallelism, -(-events.count() // LOAD_EVENTS))
            events = events.repartition(tasks, "event_id", "subject_id", "charttime")
        rows = (
            events.select(
                "subject_id", "hadm_id", "icustay_id", "charttime", "event_id",
                F.inline(F.array(*structs)).alias(
                    "tbl", "r_keep", "row_id", "itemid", "r_value", "r_valuenum"))
            .where("r_keep").drop("r_keep")
            .withColumnsRenamed({"r_value": "value", "r_valuenum": "valuenum"})
        )
        if not self.materialize:
            return rows
        root = ensure_checkpoint_dir(self.spark).rstrip("/")
        path = f"{root}/stayframe/{self.run_id}/event_rows"
        # the rows are not shuffled: every task writes its own, one file per table
        (rows.sortWithinPartitions("tbl", "itemid")
         .write.mode("overwrite").partitionBy("tbl").parquet(path))
        return self.spark.read.parquet(path)

    def _event_table(self, table: str) -> DataFrame:
        rows = self.event_rows.where(F.col("tbl") == table)
        sources = spec.COLUMN_SOURCES[table]
        out = []
        for c in spec.EVENT_TABLE_COLUMNS[table]:
            expr = F.expr(sources[c]) if c in sources else F.col(c)
            out.append(expr.alias(c))
        df = rows.select(*out)
        if "error" in df.columns:
            df = df.withColumn("error", F.col("error").cast("int"))
        return df

    @cached_property
    def chartevents(self) -> DataFrame:
        return self._event_table("chartevents")

    @cached_property
    def labevents(self) -> DataFrame:
        return self._event_table("labevents")

    @cached_property
    def outputevents(self) -> DataFrame:
        return self._event_table("outputevents")

    @cached_property
    def inputevents_cv(self) -> DataFrame:
        return self._event_table("inputevents_cv")

    @cached_property
    def inputevents_mv(self) -> DataFrame:
        return self._event_table("inputevents_mv")

    @cached_property
    def procedureevents_mv(self) -> DataFrame:
        return self._event_table("procedureevents_mv")

    @cached_property
    def datetimeevents(self) -> DataFrame:
        return self._event_table("datetimeevents")

    # -- dimensions -------------------------------------------------------------
    @cached_property
    def subjects(self) -> DataFrame:
        users = self.raw("events").groupBy(F.col("user_id").alias("u"))
        return self._stored(users.agg(F.max("ts").alias("last_ts")), "subjects")

    @cached_property
    def icustays(self) -> DataFrame:
        u = F.col("u")
        k = F.col("k")
        intime = _origin(u) + F.make_dt_interval(
            (k * spec.STAY_SPACING_DAYS).cast("int"))
        span = F.timestamp_diff("MICROSECOND", _origin(u), F.col("last_ts"))
        last_k = F.greatest(F.lit(0), F.floor(span / F.lit(spec.STAY_SPACING_DAYS * _US_PER_DAY)))
        stays = self.subjects.select(
            "u", F.explode(F.sequence(F.lit(0).cast("bigint"), last_k.cast("bigint"))).alias("k"))
        return self._stored(stays.select(
            u.alias("subject_id"),
            F.expr(spec.STAY_RULES["hadm_id"]).alias("hadm_id"),
            F.expr(spec.STAY_RULES["icustay_id"]).alias("icustay_id"),
            intime.alias("intime"),
            (intime + F.make_dt_interval(
                (F.lit(3) + (u * spec.ID_STRIDE + k) % 6).cast("int"))).alias("outtime"),
            F.expr(spec.STAY_RULES["dbsource"]).alias("dbsource"),
        ), "icustays")

    @cached_property
    def admissions(self) -> DataFrame:
        h = F.col("hadm_id")
        g = self.icustays.groupBy("subject_id", "hadm_id").agg(
            (F.min("intime") - F.expr("INTERVAL 6 HOURS")).alias("admittime"),
            (F.max("outtime") + F.expr("INTERVAL 12 HOURS")).alias("dischtime"),
            F.max("outtime").alias("_last_out"),
        )
        death = (
            F.when(h % 7 == 0, F.col("_last_out") - F.expr("INTERVAL 1 HOUR"))
            .when(h % 11 == 0, F.col("_last_out") + F.expr("INTERVAL 6 HOURS"))
        )
        u = F.col("subject_id")
        adm_type = F.element_at(F.array(*[F.lit(t) for t in spec.ADMISSION_TYPES]),
                                (h % 4 + 1).cast("int"))
        return self._stored(g.select(
            "subject_id", "hadm_id", "admittime", "dischtime",
            death.alias("deathtime"),
            F.when(death.isNotNull(), "DEAD/EXPIRED").otherwise("HOME")
            .alias("discharge_location"),
            adm_type.alias("admission_type"),
            F.when(u % 5 == 0, "BLACK/AFRICAN AMERICAN").when(u % 7 == 0, None)
            .otherwise("WHITE").alias("ethnicity"),
            F.when(h % 13 == 0, 0).otherwise(1).alias("has_chartevents_data"),
        ), "admissions")

    @cached_property
    def patients(self) -> DataFrame:
        u = F.col("u")
        dob = F.lit(spec.EPOCH).cast("timestamp_ntz") - F.make_dt_interval(
            ((F.lit(10) + u % 80) * 365).cast("int"))
        return self.subjects.select(
            u.alias("subject_id"),
            F.when(u % 17 == 0, None).when(u % 2 == 0, "M").otherwise("F")
            .alias("gender"),
            dob.alias("dob"),
        )

    @cached_property
    def diagnoses_icd(self) -> DataFrame:
        adm = self.admissions.select("subject_id", "hadm_id")
        first = None
        for cond, code in spec.DIAGNOSIS_RULES:
            c = F.expr(cond)
            first = F.when(c, code) if first is None else first.when(c, code)
        first = first.otherwise(spec.DIAGNOSIS_DEFAULT)
        second = F.element_at(F.array(*[F.lit(c) for c in spec.DIAGNOSIS_SECOND]),
                              (F.col("hadm_id") % 5 + 1).cast("int"))
        return adm.select(
            "subject_id", "hadm_id",
            F.inline(F.array(
                F.struct(F.lit(1).cast("bigint").alias("seq_num"),
                         first.alias("icd9_code")),
                F.struct(F.lit(2).cast("bigint").alias("seq_num"),
                         second.alias("icd9_code")),
            )),
        )

    @cached_property
    def services(self) -> DataFrame:
        adm = self.admissions.select("hadm_id", "admittime")
        svc = F.element_at(F.array(*[F.lit(s) for s in spec.SERVICES]),
                           (F.col("hadm_id") % 3 + 1).cast("int"))
        return adm.select(
            "hadm_id",
            F.inline(F.array(
                F.struct(svc.alias("curr_service"), F.col("admittime").alias("transfertime")),
                F.struct(F.lit("MED").alias("curr_service"),
                         (F.col("admittime") + F.expr("INTERVAL 1 HOUR")).alias("transfertime")),
            )),
        )

    @cached_property
    def noteevents(self) -> DataFrame:
        """``documents`` seen as clinical notes (row_id = doc_id)."""
        d = F.col("doc_id")
        subj = d % self.subjects.agg(F.max("u") + 1).scalar()
        return self.raw("documents").select(
            d.alias("row_id"),
            subj.alias("subject_id"),
            F.when(d % 3 == 0, None).otherwise(subj * spec.ID_STRIDE).alias("hadm_id"),
            F.date_add(F.lit(spec.EPOCH[:10]).cast("date"), (d % 30).cast("int"))
            .alias("chartdate"),
            F.expr(spec.NOTE_CATEGORY).alias("category"),
            F.expr(spec.NOTE_TEXT).alias("text"),
        )

    @cached_property
    def d_items(self) -> DataFrame:
        return (self.chartevents.select("itemid").distinct()
                .select("itemid", F.concat(F.lit("item "), F.col("itemid").cast("string"))
                        .alias("label")))

