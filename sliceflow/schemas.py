"""Schemas and enum value sets of the platform data model."""

from __future__ import annotations

from pyspark.sql import types as T

# State enums of the platform tables.
DATASET_STATES = ("INITIATED", "UPLOADING", "VALIDATING", "REGISTERING", "READY",
                  "FAILED", "DEPRECATED")
JOB_STATES = ("SUBMITTED", "VALIDATING", "QUEUED", "PROVISIONING", "RUNNING",
              "AGGREGATING", "RETRYING", "SUCCEEDED", "FAILED", "CANCELLED")
RUN_STATES = ("SUBMITTED", "PLANNING", "PROVISIONING", "RUNNING", "AGGREGATING",
              "SUCCEEDED", "FAILED", "CANCELLED")
TASK_STATES = ("PENDING", "LEASED", "RUNNING", "CHECKPOINTING", "SUCCEEDED",
               "FAILED", "DEAD")
OUTBOX_STATUSES = ("PENDING", "DELIVERED", "FAILED")
WORKSPACE_PLANS = ("free", "pro", "enterprise")
FILE_FORMATS = ("csv", "parquet", "json", "jsonl")

# Duration histogram upper bounds in seconds (+Inf implied).
DURATION_BOUNDS = (1, 5, 10, 30, 60, 120, 300)

# Lease 30 s, circuit breaker trips after 3
# failures, 10 running jobs per workspace, 3 partitions per job.
LEASE_SECONDS = 30
FAILURE_THRESHOLD = 3
MAX_RUNNING_JOBS = 10
DEFAULT_PARTITIONS = 3

# Text that pandas' CSV reader treats as missing by default.
PANDAS_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

def platform_schema(table: str) -> T.StructType:
    """Schema of a control-plane table (parsed when a session exists)."""
    return T.StructType.fromDDL(PLATFORM_TABLES[table])


# Columns of the control-plane tables as DDL (timestamps without
# zone; JSON columns as text).
PLATFORM_TABLES = {
    "workspaces": ("id string, owner_id string, name string, plan string, "
                     "created_at timestamp_ntz"),
    "datasets": ("id string, workspace_id string, created_by string, name string, "
                   "state string, storage_path string, file_format string, size_bytes bigint, "
                   "created_at timestamp_ntz, updated_at timestamp_ntz"),
    "jobs": ("id string, workspace_id string, created_by string, dataset_id string, "
               "state string, entrypoint string, parameters string, compute string, "
               "retry_count int, max_retries int, idempotency_key string, error_message string, "
               "created_at timestamp_ntz, started_at timestamp_ntz, finished_at timestamp_ntz"),
    "runs": ("id string, job_id string, workspace_id string, state string, attempt_number int, "
               "tasks_total int, tasks_done int, tasks_pending int, tasks_running int, "
               "tasks_failed int, error_message string, created_at timestamp_ntz, "
               "started_at timestamp_ntz, finished_at timestamp_ntz"),
    "tasks": ("id string, run_id string, workspace_id string, state string, "
                "partition_index int, lease_owner string, lease_expires_at timestamp_ntz, "
                "retry_count int, checkpoint_path string, error_message string, "
                "created_at timestamp_ntz, started_at timestamp_ntz, finished_at timestamp_ntz"),
    "artifacts": ("id string, run_id string, workspace_id string, name string, "
                    "storage_path string, content_type string, size_bytes bigint, "
                    "created_at timestamp_ntz, expires_at timestamp_ntz"),
    "outbox": ("id string, event_type string, aggregate_id string, payload string, "
                 "status string, attempts int, created_at timestamp_ntz, "
                 "published_at timestamp_ntz"),
    "audit_logs": ("id string, workspace_id string, user_id string, action string, "
                     "resource_type string, resource_id string, metadata string, "
                     "created_at timestamp_ntz"),
}

# Enum-typed columns per table.
ENUM_COLUMNS = {
    "workspaces": {"plan": WORKSPACE_PLANS},
    "datasets": {"state": DATASET_STATES, "file_format": FILE_FORMATS},
    "jobs": {"state": JOB_STATES},
    "runs": {"state": RUN_STATES},
    "tasks": {"state": TASK_STATES},
    "outbox": {"status": OUTBOX_STATUSES},
}
