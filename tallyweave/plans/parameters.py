"""Parameters the queries and their SQL share."""

YEAR = 1996
TOP = 10
BUSY = 30
PARTITIONS = 16
SUPPORT = 50
BASKET_SIZE = 3
SUPPLIER_SUPPORT = 160
SUPPLIER_PART_SUPPORT = 15
DOCUMENT_SIMILARITY = 0.5
CHUNKS = 4
SIMILARITY = 0.22
BANDS = 50
BAND_ROWS = 2
SEED = 7
CO_RATERS = 3
NEIGHBOURS = 3
ITEM_SEPARATOR = "|"
STOPWORDS = ("the", "of", "and", "la", "le", "de", "el", "der", "die", "und")
