"""Words and limits that other readers of the tables depend on."""

# --- fixed values -----------------------------------------------------------
# load ledger
LEDGER_PENDING = "pendiente"
LEDGER_RUNNING = "en_proceso"
LEDGER_DONE = "completado"
LEDGER_FAILED = "fallido"

# account status
ACCOUNT_RUNNING = "en_proceso"
ACCOUNT_OK = "exitoso"
ACCOUNT_FAILED = "fallido"

# campaign extraction status
CAMPAIGN_PENDING = "pendiente"
CAMPAIGN_EXTRACTED = "extraccion_hecha"
CAMPAIGN_FAILED = "fallido"
CAMPAIGN_COMPLETE = "completo"
OPEN_CAMPAIGN_STATUSES = ("pendiente", "extraccion_hecha", "fallido")

# reasons of the due rule
DUE_FIRST = "primera_extraccion"
DUE_DONE_TODAY = "ya_completo_hoy"
DUE_RETRY = "reintento"
DUE_NEW_DAY = "extraccion_nueva"
DUE_UNCHANGED = "sin_cambios"

# date range modes
MODE_ALL = "maximum"
MODE_RECENT = "last_14d"
RECENT_DAYS = 14

# other limits and words
LOT_SIZE = 10
CLOSING_DAYS = 7
CENTS_PER_UNIT = 100
PURCHASE = "purchase"
PLATFORM = "Meta"
UNKNOWN_ITEM = "Desconocido"
UNKNOWN_PAGE_ERROR = "Error desconocido"
RAW_FILE_NAME = "data.json"
ENTITY_ACCOUNT = "ad_account"
EPOCH = "1970-01-01"

# process names written to the error log
PROCESS_GET_CAMPAIGNS = "get_campaigns_meta"
PROCESS_GET_INSIGHTS = "get_insights_meta"
PROCESS_LOAD_CAMPAIGNS = "upload_campaigns_meta"
PROCESS_LOAD_INSIGHTS = "upload_insights_meta"
# ----------------------------------------------------------------------------

# what may stand around a number or a time in text
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
