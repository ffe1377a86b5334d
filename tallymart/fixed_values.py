"""Constants of the retail model that results depend on.

Everything in this module is data. The synthetic jobs in
``tallymart.plans.generate`` read it; nothing here needs a Spark session.
"""

from datetime import date

# -- sizes and windows ------------------------------------------------------
N_GUESTS = 5_000
N_PRODUCTS = 500
N_STORES = 25
BASE_LINES = 135_000
PROMO_LINES = 15_000
N_BASKETS = 60_000
LINES_PER_BASKET = 4
SALES_DAYS = 90
PROMO_FIRST_DAY = 35
PROMO_DAYS = 7
STOCK_FIRST_DAY = 42
STOCK_DAYS = 14
FIRST_SIGNUP = date(2022, 1, 1)
FIRST_OPENING = date(2015, 1, 1)
OPENING_DAYS = 2_900

# -- merchandise ------------------------------------------------------------
CATEGORIES = ["Bottoms", "Tops", "Outerwear", "Accessories", "Footwear"]
CATEGORY_WEIGHTS = [0.30, 0.30, 0.15, 0.15, 0.10]
SUBCATEGORIES = {
    "Bottoms": ["Leggings", "Joggers", "Shorts"],
    "Tops": ["Tanks", "Long Sleeve", "Short Sleeve"],
    "Outerwear": ["Jackets", "Vests"],
    "Accessories": ["Bags", "Headwear", "Socks"],
    "Footwear": ["Trainers", "Sandals"],
}
PRICE_LOW = {"Bottoms": 68, "Tops": 48, "Outerwear": 118, "Accessories": 12, "Footwear": 78}
PRICE_HIGH = {"Bottoms": 128, "Tops": 98, "Outerwear": 248, "Accessories": 58, "Footwear": 148}
PRODUCT_LINES = ["Ascend", "Motion", "Flexline", "Core", "Summit", "Horizon"]
BRANDS = ["Ascend Athletics", "Horizon Studio", "CoreForm", "Summit & Co", "Flexline"]
COST_SHARE_LOW = 0.35
COST_SHARE_RANGE = 0.20

# -- geography --------------------------------------------------------------
REGIONS = ["West", "Central", "East", "South"]
GUEST_REGION_WEIGHTS = [0.35, 0.25, 0.25, 0.15]
STATE_OF_REGION = {"West": "CA", "Central": "TX", "East": "NY", "South": "GA"}
# (region, district, number of stores), in store order
STORE_BLOCKS = [
    ("West", "West-1", 4),
    ("West", "West-2", 4),
    ("Central", "Central-1", 4),
    ("Central", "Central-2", 3),
    ("East", "East-1", 3),
    ("East", "East-2", 3),
    ("South", "South-1", 2),
    ("South", "South-2", 2),
]

# -- baskets, promotion, stock ----------------------------------------------
ONE_UNIT_SHARE = 0.70
TWO_UNIT_SHARE = 0.93
PROMO_DISCOUNT_PERCENT = 20
TAX_PERCENT = 8
PROMO_CATEGORY = "Bottoms"
DEPLETED_REGION = "South"
STOCK_PROMO_CATEGORY = 60
STOCK_OTHER = 120
STOCK_NOISE_WIDTH = 10
DEPLETED_FIRST_STOCK = 18
DEPLETED_DAILY_DROP = 2

# -- name pools of our own --------------------------------------------------
FIRST_NAMES = [
    "Ada", "Bela", "Cora", "Dario", "Elif", "Femi", "Greta", "Hugo", "Iris", "Jonas",
    "Kira", "Leon", "Mara", "Nils", "Olga", "Pavel", "Quinn", "Rosa", "Samir", "Tessa",
    "Umar", "Vera", "Wim", "Yuki", "Zara",
]
LAST_NAMES = [
    "Abel", "Brandt", "Castro", "Duarte", "Eklund", "Farkas", "Grant", "Hansen", "Ito", "Jansen",
    "Keller", "Lund", "Moreau", "Novak", "Okafor", "Petrov", "Quist", "Rossi", "Silva", "Tanaka",
    "Ueda", "Varga", "Weber", "Yilmaz", "Zeman",
]
CITIES = [
    "Alder Bay", "Birchwood", "Clearford", "Dunmere", "Eastholm", "Fairhaven", "Glenrock",
    "Harrow Point", "Ivydale", "Juniper Falls", "Kingsmead", "Larkspur", "Millbrook", "Northgate",
    "Oakhurst", "Pinecrest", "Quarry Hill", "Riverton", "Stonebridge", "Thornbury",
]
