"""Operator inputs made from the given tables, in memory or landed as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import audit
from ..operators.lineage import distinct_links
from ..operators.skew import tasks_for
from ..session import scratch_path
from .views import spark_view

_LANDED: dict[tuple[str, str, str], str] = {}


def _when(condition: Column, value: Column | str) -> Column:
    return F.when(condition, F.col(value) if isinstance(value, str) else value)


class Inputs:
    """Views and landed files of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        return spark_view(self.spark, self.sf_dir, name)

    def landed(self, key: str, write) -> str:
        """Path of a folder that ``write(path)`` fills once per application and data."""
        slot = (self.spark.sparkContext.applicationId, self.sf_dir, key)
        if slot not in _LANDED:
            path = scratch_path(self.spark, key)
            write(path)
            _LANDED[slot] = path
        return _LANDED[slot]

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def rename_parts(self, parts: str, folder: str, ending: str) -> None:
        """Give the files of each ``key=value`` folder the name of its value, numbered if several."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        as_path = jvm.org.apache.hadoop.fs.Path
        fs = as_path(parts).getFileSystem(conf)
        fs.mkdirs(as_path(folder))
        for part in fs.listStatus(as_path(parts)):
            if part.isDirectory():
                name = part.getPath().getName().split("=", 1)[1]
                files = sorted((f.getPath() for f in fs.listStatus(part.getPath())), key=lambda f: f.getName())
                for k, file in enumerate(files):
                    number = f".{k:05d}" if len(files) > 1 else ""
                    fs.rename(file, as_path(f"{folder}/{name}{number}{ending}"))

    # --- audit ---

    def audit_json(self) -> DataFrame:
        """The audit view as JSON text, in three sets of field spellings, with bad lines."""
        a = self.view("audit")
        form, kind = F.col("ts_form"), F.col("event_id") % 3
        number = F.when(form < 4, F.call_function("div", "evt_ms", F.lit(1000))).otherwise(F.col("evt_ms"))
        one, two, three = kind == 0, kind == 1, kind == 2
        numeric = form >= 2

        def spread(value: str, *names: str) -> list[Column]:
            # the second set also has an empty first spelling, which must be passed over
            return [
                F.when(one, F.col(value)).when(two, F.lit("")).alias(names[0]),
                _when(two, value).alias(names[1]), _when(three, value).alias(names[2])]

        record = F.struct(
            _when(numeric & one, number).alias("evtTime"),
            F.when(form == 0, F.col("raw_time")).when(form == 1, F.col("iso_time"))
            .when(two, number.cast("string")).alias("eventTime"),
            _when(numeric & three, number).alias("time"),
            *spread("repo", "repoName", "repositoryName", "serviceName"),
            *spread("usr", "user", "reqUser", "accessUser"),
            *spread("proxy", "doAsUser", "proxyUser", "impersonator"),
            _when(one, "ugi").alias("ugi"), _when(~one, "ugi").alias("userGroupInformation"),
            *spread("ip", "clientIP", "cliIP", "remoteIP"),
            *spread("host", "clientHost", "host", "remoteHost"),
            *spread("access", "accessType", "access", "access_type"),
            *spread("action", "action", "event", "auditType"),
            *spread("outcome", "result", "isAllowed", "allowed"),
            F.col("policy").alias("policyId"),
            *spread("path", "resourcePath", "resourceName", "resource"),
            *spread("request", "requestData", "queryString", "sql"),
            *spread("app", "app", "yarnAppName", "sessionId"))
        good = F.when(F.col("event_id") % 20 == 0, F.concat(F.lit("  "), F.to_json(record), F.lit(" \t"))
                      ).otherwise(F.to_json(record))
        n = F.col("event_id")
        extra = [
            F.when(n % 17 == 0, "not json at all"), F.when(n % 19 == 0, '{"evtTime": 17, oops}'),
            F.when(n % 23 == 0, "   "), F.when(n % 29 == 0, '{"evtTime": 1},{"evtTime": 2}')]
        lines = F.explode(F.array_compact(F.array(good, *extra))).alias("line")
        return a.select(lines, F.col("src").alias("source_file"), "day8", "repo")

    def audit_lines(self) -> DataFrame:
        """Landed JSON lines; the folder stands for the source file."""
        def write(path):
            self.audit_json().select("line", "source_file").write.partitionBy("source_file").text(path)
        found = self.spark.read.text(self.landed("audit_lines", write))
        return found.select(F.col("value").alias("line"), "source_file")

    def events(self) -> DataFrame:
        return audit.events(self.audit_lines())

    def landed_events(self) -> DataFrame:
        """Events as they are after the first job: normalised once, stored as Parquet."""
        path = self.landed("events", lambda p: self.events().write.parquet(p))
        return self.spark.read.parquet(path)

    def audit_root(self) -> str:
        """JSON lines in dated folders: ``cm_hive`` nested, the other services flat."""
        return self.landed("audit_root", self._write_audit_root)

    def _write_audit_root(self, path: str) -> None:
        df = self.audit_json()
        parts = df.select(
            "line", F.when(F.col("repo") == "cm_hive", "cm_hive/cm_hive").otherwise(F.col("repo")).alias("folder"),
            "day8")
        # written with k=v folders, which are then given their plain names
        parts.select("line", F.translate("folder", "/", "|").alias("f"), F.col("day8").alias("d")) \
            .write.partitionBy("f", "d").text(path)
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        as_path = jvm.org.apache.hadoop.fs.Path
        fs = as_path(path).getFileSystem(conf)
        for service in fs.listStatus(as_path(path)):
            if not service.isDirectory():
                continue
            name = service.getPath().getName().split("=", 1)[1].replace("%7C", "|").replace("|", "/")
            fs.mkdirs(as_path(f"{path}/{name}"))
            for day in fs.listStatus(service.getPath()):
                plain = day.getPath().getName().split("=", 1)[1]
                fs.rename(day.getPath(), as_path(f"{path}/{name}/{plain}"))

    def flat_records(self) -> DataFrame:
        """Typed audit records as the Parquet pair reads them."""
        path = self.landed("flat_json", self._write_flat_json)
        from ..sources import flat_audit
        return flat_audit(self.spark, path)

    def _write_flat_json(self, path: str) -> None:
        a, one, n = self.view("audit"), F.col("event_id") % 2 == 0, F.col("event_id")
        rest = [
            F.when(n % 15 != 0, F.col("repo")).alias("repoName"),
            _when(one, "usr").alias("user"), _when(~one, "usr").alias("reqUser"),
            _when(one, "ip").alias("clientIP"), _when(~one, "ip").alias("cliIP"),
            _when(one, F.trim("access")).alias("accessType"), _when(~one, "access").alias("access"),
            _when(one, "outcome").alias("result"), _when(~one, "outcome").alias("accessResult"),
            _when(one, "path").alias("resourcePath"), _when(~one, "path").alias("resourceName"),
            F.col("request").alias("requestData")]

        def line(time: Column) -> Column:
            return F.to_json(F.struct(time.alias("evtTime"), *rest))

        # as a number, as a number with a fraction or exponent, quoted, and as no number at all
        lines = F.when(F.col("ts_form") == 0, line(F.lit("soon"))).when(n % 3 == 0, line(F.col("evt_ms"))).when(
            n % 3 == 1, line(F.col("evt_ms").cast("double"))).otherwise(line(F.col("evt_ms").cast("string")))
        a.select(lines.alias("value")).write.text(path)

    # --- lineage ---

    def entities(self, view: str = "entities") -> DataFrame:
        e = self.view(view)
        return e.select(
            "guid", F.col("type_name").alias("typeName"),
            F.struct(
                F.col("qn").alias("qualifiedName"), "name", F.col("display").alias("displayText"),
                "owner", F.col("creator").alias("createdBy")).alias("attributes"),
            F.struct(F.col("unique_qn").alias("qualifiedName")).alias("uniqueAttributes"), "pos")

    def catalog_dump(self) -> str:
        """Export folder with ``entities`` and ``lineage`` JSON lines."""
        return self.landed("catalog_dump", self._write_catalog_dump)

    def _write_catalog_dump(self, path: str) -> None:
        # sorted part files: the place of a record decides which of two names wins
        rows = self.entities().orderBy("pos").select(F.to_json(F.struct(
            "guid", "typeName", "attributes", "uniqueAttributes")).alias("value"))
        # compressed, in files of bounded length, as these cannot be split: many tasks read them
        landed = {"compression": "gzip", "maxRecordsPerFile": 100_000}
        rows.write.options(**landed).text(f"{path}/entities")
        self.payloads().select(F.to_json(F.struct("seedGuid", "typeName", "lineage")).alias("value")).write.options(**landed).text(f"{path}/lineage")

    def payloads(self) -> DataFrame:
        """One payload per order line: supplier and part feed each other through two
        processes, and a plain entity stands beside them."""
        li = self.table("lineitem")
        s = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
        p = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
        order = F.concat(F.lit("o"), F.col("l_orderkey").cast("string"))
        load = F.concat(F.lit("load"), F.col("l_orderkey").cast("string"))
        back = F.concat(F.lit("back"), F.col("l_orderkey").cast("string"))
        empty = F.lit(None).cast("string")

        def entity(kind: str, name: Column) -> Column:
            return F.struct(
                empty.alias("guid"), F.lit(kind).alias("typeName"),
                F.struct(name.alias("qualifiedName"), *[empty.alias(n) for n in (
                    "name", "displayText", "owner", "createdBy")]).alias("attributes"),
                F.struct(empty.alias("qualifiedName")).alias("uniqueAttributes"))

        def relation(a: Column, b: Column) -> Column:
            return F.struct(a.alias("fromEntityId"), b.alias("toEntityId"))

        entities = F.map_from_arrays(
            F.array(s, load, p, back, order),
            F.array(
                entity("hdfs_path", F.concat(F.lit("own:"), s)), entity("hive_Process", empty),
                entity("hive_table", F.concat(F.lit("own:"), p)), entity("spark_process", empty),
                entity("hive_table", F.concat(F.lit("own:"), order))))
        relations = [
            relation(s, load), relation(load, p), relation(s, load), relation(load, s),
            relation(p, order), relation(empty, load)]
        returns = [relation(p, back), relation(back, s)]
        both = F.when(
            F.col("l_returnflag") == "R", F.array(*relations, *returns)).otherwise(F.array(*relations))
        return li.select(
            s.alias("seedGuid"), F.lit("hdfs_path").alias("typeName"),
            F.struct(entities.alias("guidEntityMap"), both.alias("relations")).alias("lineage"),
            F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.monotonically_increasing_id()).alias("payload_id"))

    def links(self, view: str = "links") -> DataFrame:
        """Links as a first job leaves them: distinct and stored, payload by payload."""
        def write(path):
            # the tables' numbers move, to the tasks of their payload, and not the texts made of them
            rows = 2 * self.table("lineitem").count() + self.table("orders").count()  # those of the views, at most
            made = spark_view(self.spark, self.sf_dir, view, {"lineitem": "l_orderkey", "orders": "o_orderkey"}, tasks_for(self.spark, rows))
            distinct_links(made).sortWithinPartitions("payload_id", "role").write.option("compression", "zstd").parquet(path)
        found = self.spark.read.parquet(self.landed(view, write))
        return found.withColumn("own_name", F.col("guid")).withColumn("name", F.col("guid"))

    # --- histories ---

    def rm_apps(self) -> DataFrame:
        return self.view("rm_apps").withColumnRenamed("started", "startedTime")

    def jhs_jobs(self) -> DataFrame:
        return self.view("jhs_jobs").withColumnsRenamed(
            {"start_ms": "startTime", "submit_ms": "submitTime"})

    def spark_apps(self) -> DataFrame:
        v = self.view("spark_apps")
        user = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
        first = F.struct(F.col("first_start").alias("startTime"), F.lit("first").alias("sparkUser"))
        last = F.struct(F.col("last_start").alias("startTime"), user.alias("sparkUser"))
        none = F.array().cast("array<struct<startTime:string,sparkUser:string>>")
        n = F.col("attempts_n")
        attempts = F.when(n == 0, none).when(n == 1, F.array(last)).otherwise(F.array(first, last))
        return v.select("id", "name", attempts.alias("attempts"), "day", "pos")

    # --- projects ---

    def projects(self) -> DataFrame:
        v = self.view("projects")
        form, user = F.col("owner_form"), F.col("owner_user")
        owner = (
            F.when(form == 0, F.to_json(F.struct(user.alias("username"))))
            .when(form == 1, F.lit("{}"))
            .when(form == 2, F.to_json(F.struct(F.lit("").alias("username"), user.alias("name"))))
            .otherwise(user))
        return v.select(
            "id", F.lit(None).cast("string").alias("project_id"), "name", "slug",
            owner.alias("owner"), "description", F.col("engine").alias("default_engine_type"),
            F.col("created").alias("created_at"), F.lit(None).cast("string").alias("createdAt"), "pos")

    def children(self) -> DataFrame:
        v = self.view("children")
        owner = F.when(F.col("worker").isNotNull(), F.to_json(F.struct(F.col("worker").alias("username"))))
        return v.select(
            "project_id", "id", "name", "title", "script", "kernel", "engine_type", "schedule",
            owner.alias("owner"), "created_at", F.lit(None).cast("string").alias("createdAt"),
            "updated_at", F.struct(F.col("latest_at").alias("started_at")).alias("latest"), "pos")

    # --- listings and tables ---

    def listing(self) -> DataFrame:
        from ..sources import listing_table
        return listing_table(
            self.view("listing"), owner="owner_name", group="group_name", permissions="perms")

    def databases(self) -> DataFrame:
        tables = self.view("hive_tables")
        return tables.groupBy("db").agg(F.min("pos").alias("pos"))

    def hive_tables(self) -> DataFrame:
        return self.view("hive_tables").select("db", "tbl", "pos")

    def describe_lines(self, view: str = "describe_lines") -> DataFrame:
        return self.view(view)
