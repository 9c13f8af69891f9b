"""Output column lists, input schemas and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

EVENT_COLUMNS = [
    "event_ts", "service", "user", "do_as", "ugi", "client_ip", "client_host",
    "access_type", "action", "op", "result", "policy_id", "resource",
    "resource_dir", "resource_norm", "resource_hash", "app_name",
    "request_data", "request_hash", "source_file",
]
SUMMARY_KEYS = [
    "window_start", "service", "user", "do_as", "ugi", "client_ip", "op", "resource_norm",
]
SUMMARY_COLUMNS = SUMMARY_KEYS + ["first_seen", "last_seen", "cnt"]
ACCESS_COLUMNS = [
    "window_start", "service", "user", "do_as", "client_ip", "app_name", "op",
    "object_type", "object_id", "cnt",
]
OBJECT_COLUMNS = ["service", "object_type", "object_id", "owner", "group", "extra"]
LINEAGE_COLUMNS = [
    "from_object_type", "from_object_id", "to_object_type", "to_object_id", "relation",
]

# Audit field -> accepted JSON spellings in order of preference, text limit.
AUDIT_FIELDS = {
    "event_ts": (["evtTime", "eventTime", "time", "accessTime"], 64),
    "service": (["repoName", "repositoryName", "serviceName", "repo"], 256),
    "user": (["user", "reqUser", "accessUser"], 256),
    "do_as": (["doAsUser", "proxyUser", "impersonator", "proxy"], 256),
    "ugi": (["ugi", "userGroupInformation"], 512),
    "client_ip": (["clientIP", "cliIP", "client_ip", "ip", "remoteIP"], 128),
    "client_host": (["clientHost", "clientHostname", "host", "remoteHost"], 256),
    "access_type": (["accessType", "access", "access_type"], 128),
    "action": (["action", "event", "auditType"], 128),
    "result": (["result", "accessResult", "isAllowed", "allowed"], 64),
    "policy_id": (["policyId", "policy_id", "policy"], 64),
    "resource": (["resourcePath", "resourceName", "resource", "resource_path"], 8000),
    "request_data": (["requestData", "request", "queryString", "sql"], 16000),
    "app_name": (
        ["app", "application", "applicationName", "appName", "yarnAppName",
         "sparkAppName", "oozieJobId", "workflowId", "sessionId"], 256),
}

# Access words.
WRITE_WORDS = [
    "write", "update", "create", "delete", "alter", "drop", "truncate", "append",
    "rename", "setpermission", "setowner", "mkdir", "rmdir", "move",
]
READ_WORDS = [
    "read", "open", "list", "get", "getfileinfo", "getfilestatus", "liststatus",
    "stat", "content", "execute",
]
WRITE_FRAGMENTS = ["write", "create", "delete", "append", "rename", "alter", "drop"]
FLAT_WRITE_WORDS = ["write", "update", "create", "delete", "alter", "drop", "put", "add"]
METADATA_OPS = ["getfileinfo", "liststatus", "getfilestatus"]
ALLOWED_WORDS = ["1", "true", "True", "allowed", "ALLOW"]
DENIED_WORDS = ["0", "false", "False", "denied", "DENY"]

# Path parts that mark temporary or bookkeeping files, in any case. A commit
# marker counts only where a name starts, not inside a word.
NOISE_PATTERN = "|".join([
    "(?i)_temporary", "_spark_metadata", "/_success", r"/\.trash/", r"/\.staging/", "/tmp/",
    r"\.sparkstaging", r"\.crc[\s\p{Z}]*$", r"(?:^|[^\p{L}\p{N}_])_committed_",
])

# Word inside a service name -> object type, first match wins.
SERVICE_OBJECT_TYPES = {
    "hdfs": "hdfs_path",
    "hive": "hive_table",
    "kudu": "kudu_table",
    "impala": "hive_table",
    "yarn": "application",
    "spark": "application",
}
# Catalog type -> service.
TYPE_SERVICES = {
    "hive_db": "hive",
    "hive_table": "hive",
    "hive_column": "hive",
    "hive_storagedesc": "hive",
    "hdfs_path": "hdfs",
    "kudu_table": "kudu",
    "impala_table": "impala",
    "impala_db": "impala",
    "spark_application": "spark",
}
# Word inside an input format or serde -> storage name, first match wins.
STORAGE_WORDS = {
    "kudu": "kudu", "parquet": "parquet", "orc": "orc", "text": "textfile",
    "rcfile": "rcfile", "avro": "avro", "sequencefile": "sequencefile", "json": "json",
}
STRICT_STORAGE_WORDS = {
    "kudu": "kudu", "parquet": "parquet", "orc": "orc", "text": "textfile",
    "avro": "avro", "rcfile": "rcfile", "sequence": "sequencefile", "json": "json",
}
EXCLUDED_DATABASES = ["sys", "information_schema", "_impala_builtins"]
DATABASE_HEADERS = ["name", "database_name"]
TABLE_HEADERS = ["name", "tab_name"]
APP_STATES = ["FINISHED", "KILLED", "FAILED", "RUNNING"]
RAW_JSON_LIMIT = 65000


def _struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


AUDIT_JSON = _struct(*[s for spellings, _ in AUDIT_FIELDS.values() for s in spellings])

# the time may be a number, with a fraction too, or a quoted one
FLAT_AUDIT_JSON = _struct(
    "evtTime", "repoName", "user", "reqUser", "clientIP", "cliIP", "accessType", "access",
    "result", "accessResult", "resourcePath", "resourceName", "requestData")

ENTITY = T.StructType([
    T.StructField("guid", T.StringType()),
    T.StructField("typeName", T.StringType()),
    T.StructField(
        "attributes", _struct("qualifiedName", "name", "displayText", "owner", "createdBy")),
    T.StructField("uniqueAttributes", _struct("qualifiedName")),
])
RELATION = _struct("fromEntityId", "toEntityId")
# what lineage needs of the entities named in a payload
LINEAGE_ENTITY = T.StructType([
    T.StructField("typeName", T.StringType()),
    T.StructField("attributes", _struct("qualifiedName")),
    T.StructField("uniqueAttributes", _struct("qualifiedName")),
])
LINEAGE = T.StructType([
    T.StructField("seedGuid", T.StringType()),
    T.StructField("typeName", T.StringType()),
    T.StructField("lineage", T.StructType([
        T.StructField("guidEntityMap", T.MapType(T.StringType(), LINEAGE_ENTITY)),
        T.StructField("relations", T.ArrayType(RELATION)),
    ])),
])
RM_APP = T.StructType([
    *_struct("id", "user", "name", "state").fields,
    T.StructField("startedTime", T.LongType()),
])
RM_PAGE = T.StructType([
    T.StructField("apps", T.StructType([T.StructField("app", T.ArrayType(RM_APP))]))])
JHS_JOB = T.StructType([
    *_struct("id", "user", "name").fields,
    T.StructField("startTime", T.LongType()),
    T.StructField("submitTime", T.LongType()),
])
JHS_PAGE = T.StructType([
    T.StructField("jobs", T.StructType([T.StructField("job", T.ArrayType(JHS_JOB))]))])
SPARK_APP = T.StructType([
    *_struct("id", "name").fields,
    T.StructField("attempts", T.ArrayType(_struct("startTime", "sparkUser"))),
])

# ``owner`` arrives as an object or as plain text, so it is read as (JSON) text.
PROJECT = _struct(
    "id", "project_id", "name", "slug", "owner", "description", "default_engine_type",
    "created_at", "createdAt")
PROJECT_CHILD = T.StructType([
    *_struct(
        "project_id", "id", "name", "title", "script", "kernel", "engine_type", "schedule",
        "owner", "created_at", "createdAt", "updated_at").fields,
    T.StructField("latest", _struct("started_at")),
])
