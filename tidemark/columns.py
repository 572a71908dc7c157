"""Column and status names shared by every operator: fixed values of the data model."""

ACCOUNT = "account_id_hashed"
USER = "user_id_hashed"
ACCOUNT_TYPE = "account_type"
STATUS = "account_status"
CREATED = "created_ts"
CLOSED = "closed_ts"
REOPENED = "reopened_ts"
TX_DATE = "date"
TX_COUNT = "transactions_num"
TOTAL = "total_transactions"
FLAG = "multiple_closures_without_reopen_flag"
CALC_DATE = "calculation_date"

OPEN, REOPENED_STATE, CLOSED_STATE = "open", "reopened", "closed"
