"""Constants and lookup lists that results depend on."""

# Constant columns.
BANK_NAME = "Attijariwafa Bank"
CURRENCY = "MAD"
COUNTRY_RAW = "Maroc"          # written by the silver layer
COUNTRY = "Morocco"            # default from staging onwards

# Channel codes.
CHANNEL_ATM = "CARD_ATM"
CHANNEL_WALLET = "MOBILE_WALLET"
CHANNEL_ONLINE = "ONLINE"
CHANNEL_POS = "CARD_POS"
CHANNEL_SWIPE = "CARD_SWIPE"

# Text labels in the raw records.
YES_LABELS = ["YES", "OUI", "TRUE", "1"]
DEPOSIT_TYPES = ["Dépôt", "Deposit"]
CREDIT_LABELS = ["CREDIT", "CRÉDIT"]
DEBIT_LABELS = ["DEBIT", "DÉBIT"]
ONLINE_LABELS = ["Online Transaction", "Transaction en ligne"]
CHIP_LABELS = ["Chip Transaction", "Transaction par puce"]
EMPTY_ATM_REASON = "GUICHET VIDE"

# Message and response codes.
MSG_DEFAULT = 210
MSG_REVERSAL = 430
RESP_OK = 0
RESP_OUT_OF_CASH = 96
VALID_RESP_CODES = [0, 14, 43, 51, 54, 57, 61, 91, 96]

# Calendar.
CALENDAR_START = "2023-01-01"
CALENDAR_END_EXCLUSIVE = "2027-12-31"
HOLIDAYS = ["01-01", "01-11", "03-03", "05-01", "07-30", "08-14", "08-20", "11-06", "11-18"]

# Regions.
MACRO_REGIONS = {
    "NORTH": ["Casablanca-Settat", "Rabat-Salé-Kénitra", "Tanger-Tétouan-Al Hoceïma", "Fès-Meknès"],
    "SOUTH": ["Marrakech-Safi", "Souss-Massa", "Drâa-Tafilalet", "Guelmim-Oued Noun"],
    "EAST": ["Oriental", "Béni Mellal-Khénifra"],
}
POPULATION_TIERS = {
    "TIER_1": ["Casablanca-Settat"],
    "TIER_2": ["Rabat-Salé-Kénitra", "Tanger-Tétouan-Al Hoceïma", "Fès-Meknès", "Marrakech-Safi"],
}

# Merchant category codes: two different groupings are in use.
ATM_MCC = "6011"
MERCHANT_GROUPS = {
    "GROCERY": ["5411", "5412", "5422"],
    "FOOD_BEVERAGE": ["5812", "5813", "5814"],
    "FUEL": ["5541", "5542", "5983"],
    "TRANSPORT": ["4111", "4112", "4131"],
    "FINANCIAL": ["6011", "6012"],
    "RETAIL": ["5310", "5311", "5331"],
    "HOSPITALITY": ["7011", "7012"],
}
CATEGORY_GROUPS = {
    "Financial Services": ["6011", "6012", "6051"],
    "Food & Beverage": ["5411", "5422", "5812"],
    "Fuel": ["5541", "5983"],
    "Transport & Telecom": ["4111", "4131", "4814"],
    "Retail": ["5310", "5311", "5045"],
    "Hospitality": ["7011", "7012"],
}
MCC_DESCRIPTIONS = {
    "6011": "Automated Cash Disbursements",
    "5411": "Grocery Stores",
    "5812": "Eating Places & Restaurants",
    "5541": "Service Stations",
    "4111": "Transportation",
    "5310": "Discount Stores",
    "7011": "Hotels & Lodging",
    "5912": "Drug Stores & Pharmacies",
    "5045": "Electronics",
    "4814": "Telecommunication Services",
}
HIGH_RISK_MCC = ["6011", "7995", "5933"]

# Exchange rates to MAD; an unknown currency counts as 1.0.
MAD_RATES = {"MAD": 1.0, "USD": 10.0, "EUR": 10.9, "GBP": 12.7, "AED": 2.72, "SAR": 2.67}

# Text that stands for NULL inside a surrogate key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"

# Seed tables.
CHANNELS = [
    (1, "CARD_ATM", "Card ATM", "Physical ATM card transaction", False, True),
    (2, "MOBILE_WALLET", "Mobile Wallet", "Mobile wallet transaction via ATM", True, True),
    (3, "CARD_POS", "Card POS", "Card transaction at point of sale", False, False),
    (4, "ONLINE", "Online", "Online card transaction", True, False),
    (5, "CARD_SWIPE", "Card Swipe", "Magnetic stripe card transaction", False, False),
]
ERROR_TYPES = [
    (1, 0, "Success", "SUCCESS", False, True),
    (2, 96, "ATM Out of Cash", "OPERATIONAL", False, True),
    (3, 51, "Insufficient Funds", "DECLINED", False, True),
    (4, 14, "Invalid Card Number", "DECLINED", True, True),
    (5, 61, "Withdrawal Limit Exceeded", "DECLINED", False, True),
    (6, 43, "Card Reported Stolen", "FRAUD", True, True),
    (7, 54, "Expired Card", "DECLINED", False, True),
    (8, 57, "Transaction Not Permitted", "DECLINED", False, True),
    (9, 91, "Bank System Unavailable", "TECHNICAL", False, True),
    (10, None, "No Error", "SUCCESS", False, False),
]

# Characters that part words in raw column names.
NAME_SEPARATORS = " ,;{}()\n\t="
