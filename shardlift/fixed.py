"""They must equal what snapshots and targets use, or results would differ."""

# Versions by the names users give them.
VERSION_NAMES = {
    "6.8": "6.8",
    "7.10": "7.10",
    "2.11": "2.11",
    "es_6_8": "6.8",
    "es_7_10": "7.10",
    "os_2_11": "2.11",
}
SOURCE_VERSIONS = ("6.8", "7.10")
TARGET_VERSIONS = ("2.11",)

# Decimal prefixes of a numeric version id.
VERSION_ID_PREFIXES = {"608": "6.8", "710": "7.10"}

MOVEMENTS = ("everything", "metadata", "data")

# First byte of a stored document id.
ID_NUMERIC = "FE"
ID_UTF8 = "FF"
ID_BASE64_ESCAPE = "FD"

# Mapping wrappers, in the order they are looked for.
MAPPING_WRAPPERS = ("_doc", "doc", "audit_message")

# Index settings the target refuses.
REJECTED_SETTINGS = ("creation_date", "provided_name", "uuid", "version")

SNAPSHOT_SUCCESS = "SUCCESS"
INLINE_FILE_PREFIX = "v__"
BLOB_PREFIX = "__"
TARGET_SUFFIX = "_reindexed"
UNLIMITED_PART_SIZE = 9223372036854775807

# Request paths by kind, and the order in which kinds are created.
REQUEST_PREFIXES = {
    "template": "_template/",
    "component_template": "_component_template/",
    "index_template": "_index_template/",
    "index": "",
}
STAGES = {
    "template": 0,
    "component_template": 1,
    "index_template": 2,
    "index": 3,
    "document": 4,
}

# Container files: header magic, footer magic, checksum algorithm, format version,
# and the format name expected in each kind of file.
CONTAINER_HEADER_MAGIC = "3FD76C17"
CONTAINER_FOOTER_MAGIC = "C02893E8"
CONTAINER_ALGORITHM = "00000000"
CONTAINER_VERSION = "00000001"
CONTAINER_NAMES = {
    "global": "metadata",
    "index": "index-metadata",
    "snapshot": "snapshot",
    "shard": "snapshot",
}

HTTP_OK = 200
HTTP_CREATED = 201
HTTP_NOT_FOUND = 404
HTTP_BUSY = 429
HTTP_SERVER_ERROR = 500
HTTP_UNAVAILABLE = 503
