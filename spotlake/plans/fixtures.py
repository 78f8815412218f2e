"""The given tables projected onto the shapes of the advertising data."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spotlake.operators import clean


def _every(column: str, step: int) -> Column:
    return F.col(column) % step == 0


@dataclass(frozen=True)
class Fixtures:
    """Lazy frames over one data folder. Only the columns a query asks for are read."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _places(self, df: DataFrame, nation: str) -> DataFrame:
        """Attach nation and region one after the other: two tables of known, tiny size."""
        named = df.join(self.table("nation"), F.col(nation) == F.col("n_nationkey"))
        return named.join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))

    def _outlets(self, lines: DataFrame) -> DataFrame:
        return self._places(lines.join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey")), "s_nationkey")

    @property
    def _spend(self) -> Column:
        return F.when(F.col("l_quantity") == 7, None).otherwise(F.col("l_extendedprice"))

    @cached_property
    def spots(self) -> DataFrame:
        return self._spots(self.table("lineitem"))

    def medium(self, name: str) -> DataFrame:
        """Spots of one medium; the test sits on the source column, so it reaches the scan."""
        aired = F.col("l_linestatus") == "O"
        other = F.col("l_linestatus").isNull() | (F.col("l_linestatus") != "O")
        return self._spots(self.table("lineitem").where(aired if name == "tv" else other))

    def _spots(self, lines: DataFrame) -> DataFrame:
        # customers meet the orders first, so the lines are shuffled once for both
        buyers = self.table("orders").join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        rows = lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        rows = self._outlets(rows.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey")))
        brand = (
            F.when(_every("p_partkey", 17), "N.A.").when(_every("p_partkey", 23), "")
            .when(_every("p_partkey", 29), None).otherwise(F.col("p_brand"))
        )
        return rows.select(
            F.when(F.col("l_linestatus") == "O", "tv").otherwise("radio").alias("tipo"),
            F.col("l_shipdate").cast("date").alias("Fecha"),
            F.col("n_nationkey").alias("IdLocalidad"),
            F.col("n_name").alias("Localidad"),
            F.col("r_regionkey").alias("IdMedio"),
            F.col("r_name").alias("Medio"),
            F.col("l_returnflag").alias("TipoMedio"),
            F.col("s_suppkey").cast("int").alias("IdCanal"),
            F.col("s_name").alias("Canal"),
            F.substring("p_brand", 7, 100).cast("int").alias("IdMarca"),
            brand.alias("Marca"),
            F.col("p_name").alias("Submarca"),
            F.col("p_type").alias("Producto"),
            F.col("p_partkey").alias("IdVersion"),
            F.concat_ws(" ", "p_name", "p_type").alias("Version"),
            F.col("l_quantity").cast("int").alias("DReal"),
            F.col("p_size").alias("DTeorica"),
            F.col("l_linenumber").alias("NoCorte"),
            F.col("c_custkey").alias("IdAnunciante"),
            F.when(_every("c_custkey", 31), "N.A.").otherwise(F.col("c_name")).alias("Anunciante"),
            F.when(_every("c_custkey", 37), "N.A.").otherwise(F.col("c_mktsegment")).alias("Industria"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("IdDeteccion"),
            self._spend.alias("Tarifa"),
        )

    @cached_property
    def print_ads(self) -> DataFrame:
        buyers = self.table("orders").join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        rows = self._places(buyers, "c_nationkey")
        brand = F.concat(F.lit("Brand#"), (F.col("o_custkey") % 25 + 1).cast("string"))
        return rows.select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderdate").cast("date").alias("Fecha"),
            F.col("r_regionkey").alias("IdMedio"),
            F.when(F.col("r_regionkey") == 4, None).otherwise(F.col("r_name")).alias("Medio"),
            F.col("n_nationkey").alias("IdFuente"),
            F.col("n_name").alias("Fuente"),
            F.col("o_orderstatus").alias("Seccion"),
            (F.col("o_orderkey") % 64).cast("string").alias("Pagina"),
            (F.col("o_custkey") * 100).alias("Tiraje"),
            F.when(_every("o_orderkey", 19), None).otherwise(F.col("o_totalprice")).alias("Costo"),
            F.when(_every("c_custkey", 31), "N.A.").otherwise(F.col("c_name")).alias("Anunciante"),
            F.when(_every("o_custkey", 17), "N.A.").otherwise(brand).alias("Marca"),
            F.when(_every("c_custkey", 37), "").otherwise(F.col("c_mktsegment")).alias("Sector"),
            F.col("o_orderpriority").alias("Categoria"),
            (F.col("o_totalprice") / 1000).alias("Dimension"),
        )

    @property
    def _kind(self) -> Column:
        return F.when(_every("p_size", 2), "AUDIOVISUAL").otherwise("AUDIO")

    @property
    def _industry(self) -> Column:
        return F.when(_every("p_partkey", 43), "").otherwise(F.col("p_type"))

    @cached_property
    def library(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("IdMaster"),
            self._kind.alias("TipoMaster"),
            F.concat_ws(" ", "p_name", "p_brand").alias("Version"),
            F.when(_every("p_partkey", 41), "N.A.").otherwise(F.col("p_name")).alias("Anunciante"),
            F.col("p_brand").alias("Marca"),
            self._industry.alias("Industria"),
            F.col("p_size").alias("DTeorica"),
        )

    @cached_property
    def totals(self) -> DataFrame:
        lines = self.table("lineitem").join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        rows = self._outlets(lines)
        day = F.col("l_shipdate").cast("date")
        return rows.select(
            day.alias("FechaInicio"),
            day.alias("FechaFin"),
            F.when(F.col("r_regionkey") == 4, "N.A.").otherwise(F.col("r_name")).alias("Medio"),
            F.col("p_partkey").alias("IdMaster"),
            self._kind.alias("TipoMaster"),
            F.concat_ws(" ", "p_name", "p_brand").alias("Version"),
            F.col("p_name").alias("Anunciante"),
            F.when(_every("p_partkey", 17), "N.A.").otherwise(F.col("p_brand")).alias("Marca"),
            self._industry.alias("Industria"),
            F.col("l_returnflag").alias("Segmento"),
            F.col("l_quantity").cast("int").alias("TotalHit"),
            self._spend.alias("TotalInversion"),
        )

    @cached_property
    def domain_events(self) -> DataFrame:
        kind = (
            F.when(F.col("event_type") == "view", "DataProcessed")
            .when(F.col("event_type") == "signup", "DataDeleted").otherwise("DataIngested")
        )
        step = F.col("event_id") % 10
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.col("event_id").cast("string").alias("event_id"),
            kind.alias("event_type"),
            self._user_medium.alias("aggregate_type"),
            F.date_format("ts", "yyyyMMdd").alias("aggregate_id"),
            F.col("props").alias("payload"),
            F.col("ts").alias("occurred_at"),
            F.when(step < 6, "PROCESSED").when(step < 8, "PENDING").otherwise("FAILED").alias("status"),
            F.when(step < 6, F.concat(F.lit("worker-"), (F.col("event_id") % 2).cast("string"))).alias("consumer_id"),
        )

    @property
    def _user_medium(self) -> Column:
        user = F.col("user_id") % 3
        return F.when(user == 0, "tv").when(user == 1, "radio").otherwise("impresos")

    @cached_property
    def raw(self) -> DataFrame:
        two_digits = F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")
        step = F.col("doc_id") % 8
        day = (
            F.when(step == 0, F.concat(F.lit("202601"), two_digits))
            .when(step == 1, F.concat(F.lit("2026-01-"), two_digits))
            .when(step == 2, F.concat(F.lit("2026-01-"), two_digits, F.lit("T08:30:00")))
            .when(step == 3, F.concat(F.lit("2026/01/"), two_digits))
            .when(step == 4, F.concat(two_digits, F.lit("/01/2026")))
            .when(step == 5, F.concat(two_digits, F.lit("-01-2026")))
            .when(step == 6, "").otherwise("sin fecha")
        )
        key = (
            F.when(_every("doc_id", 11), "").when(_every("doc_id", 13), "abc")
            .otherwise(F.col("doc_id").cast("string"))
        )
        brand = (
            F.when(_every("doc_id", 7), "").when(_every("doc_id", 9), "nan")
            .otherwise(F.concat(F.lit("  "), F.col("text")))
        )
        return self.table("documents").select(
            "doc_id", day.alias("Fecha"), key.alias("IdDeteccion"), brand.alias("Marca"),
            F.col("lang").alias("Medio"),
            F.when(_every("doc_id", 5), "n/d").otherwise(F.col("n_chars").cast("string")).alias("Tarifa"),
        )

    @cached_property
    def rejects(self) -> DataFrame:
        """What the live rules reject of all raw rows, dealt to the media; an empty day stands for a broken file."""
        medium = F.element_at(F.array(*map(F.lit, ("tv", "radio", "impresos"))), (F.col("doc_id") % 3 + 1).cast("int"))
        sent = self.raw.withColumn("sent", F.col("Fecha"))
        return clean.rejected(clean.clean_live("tv", sent, keep=("doc_id", "sent"))).select(
            medium.alias("tipo"), F.when(F.col("sent") == "", "corrupt").otherwise(F.col(clean.REASON)).alias("reason"),
            F.col("doc_id").cast("string").alias("drop"))

    @cached_property
    def sectors_accounts(self) -> DataFrame:
        rows = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return rows.select(
            (F.col("c_custkey") % 50).alias("id_account"), F.col("n_regionkey").alias("id_sector_src")
        )

    @cached_property
    def sectors(self) -> DataFrame:
        key = F.col("r_regionkey")
        name = (
            F.when(key == 0, "Television").when(key == 1, "Radio FM").when(key == 2, "Revistas")
            .when(key == 3, "Prensa Nacional").otherwise("Cine")
        )
        return self.table("region").select(key.alias("id"), name.alias("name"))

    @cached_property
    def notifications(self) -> DataFrame:
        """Arrival notices: some wrapped, some bare, removed, empty, misplaced or cut off."""
        step = F.col("event_id")
        notice = F.concat(
            F.lit('{"Records":[{"eventName":"'),
            F.when(step % 7 == 0, "ObjectRemoved:Delete").otherwise("ObjectCreated:Put"),
            F.lit('","s3":{"object":{"key":"'),
            F.when(step % 17 == 0, "other/").otherwise("rawdata/"),
            self._user_medium, F.lit("/"), F.date_format("ts", "yyyyMMdd"),
            F.when(step % 19 == 0, "/.keep").otherwise("/data.json"),
            F.lit('"}}}]}'),
        )
        body = F.when(step % 13 == 0, '{"Records":[]}').otherwise(notice)
        escaped = F.replace(F.col("body"), F.lit('"'), F.lit('\\"'))
        wrapped = F.concat(F.lit('{"Type":"Notification","Message":"'), escaped, F.lit('"}'))
        sent = F.when(step % 11 == 0, F.substring("body", 1, 20)).when(step % 5 == 0, F.col("body")).otherwise(wrapped)
        return self.table("events").select("event_id", body.alias("body")).select("event_id", sent.alias("body"))

    @cached_property
    def users(self) -> DataFrame:
        """A worker per region; odd regions write the name in a way the log does not know."""
        key = F.col("r_regionkey")
        name = F.concat(F.when(key % 2 == 0, "worker-").otherwise("worker "), key.cast("string"))
        return self.table("region").select(name.alias("user"), (key + 1).alias("id"))
