"""Fixed values that results depend on. Text and numbers only, no logic."""

# Age buckets, in score-vector order.
BUCKETS = ("18_24", "25_29", "30_34", "35_39", "40_49", "50")

# Coefficient of each score.
DEVICE_COEFFICIENT = 0.1
SEARCH_COEFFICIENT = 0.15
PAY_TIME_COEFFICIENT = 0.1
AMOUNT_COEFFICIENT = 0.15
BRAND_COEFFICIENT = 0.2
CATEGORY_COEFFICIENT = 0.3

# Device weights by operating system.
DEVICE_WEIGHTS = {
    "iOS": (0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "Android": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
}

# Weights by search category.
SEARCH_WEIGHTS = {
    "时尚与潮流": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    "性价比": (0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    "健康与养生": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "家庭与育儿": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "科技与数码": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    "学习与发展": (0.4, 0.5, 0.6, 0.7, 0.8, 0.7),
}

# Pay-time slots as (first hour after the slot, name), then the last slot.
PAY_TIME_SLOTS = ((6, "凌晨"), (9, "早晨"), (12, "上午"), (14, "中午"), (18, "下午"), (22, "晚上"))
LAST_PAY_TIME_SLOT = "夜间"

# Weights by pay-time slot.
PAY_TIME_WEIGHTS = {
    "凌晨": (0.2, 0.1, 0.1, 0.1, 0.1, 0.1),
    "早晨": (0.1, 0.1, 0.1, 0.1, 0.2, 0.3),
    "上午": (0.2, 0.2, 0.2, 0.2, 0.3, 0.4),
    "中午": (0.4, 0.4, 0.4, 0.4, 0.4, 0.3),
    "下午": (0.4, 0.5, 0.5, 0.5, 0.5, 0.4),
    "晚上": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "夜间": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
}

# Weights by order amount (low, middle, all other amounts) and the two limits.
AMOUNT_LOW_LIMIT = 1000
AMOUNT_HIGH_LIMIT = 4000
AMOUNT_LOW = (0.8, 0.6, 0.4, 0.3, 0.2, 0.1)
AMOUNT_MIDDLE = (0.2, 0.4, 0.6, 0.7, 0.8, 0.7)
AMOUNT_OTHER = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6)

# Weights by brand; the last line is for every other brand.
BRAND_WEIGHTS = {
    "TCL": (0.2, 0.3, 0.4, 0.5, 0.6, 0.7),
    "苹果": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "联想": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "小米": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "欧莱雅": (0.5, 0.6, 0.8, 0.8, 0.9, 0.2),
    "香奈儿": (0.3, 0.4, 0.6, 0.8, 0.9, 0.2),
}
BRAND_OTHER = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6)

# Weights by first-level category; the last line is for every other category.
CATEGORY_WEIGHTS = {
    "数码": (0.9, 0.8, 0.6, 0.4, 0.2, 0.1),
    "手机": (0.9, 0.8, 0.6, 0.4, 0.2, 0.1),
    "电脑办公": (0.9, 0.8, 0.6, 0.4, 0.2, 0.1),
    "个护化妆": (0.9, 0.8, 0.6, 0.4, 0.2, 0.1),
    "服饰内衣": (0.9, 0.8, 0.6, 0.4, 0.2, 0.1),
    "家居家装": (0.2, 0.4, 0.6, 0.8, 0.9, 0.7),
    "图书、音像、电子书刊": (0.2, 0.4, 0.6, 0.8, 0.9, 0.7),
    "厨具": (0.2, 0.4, 0.6, 0.8, 0.9, 0.7),
    "鞋靴": (0.2, 0.4, 0.6, 0.8, 0.9, 0.7),
    "母婴": (0.2, 0.4, 0.6, 0.8, 0.9, 0.7),
    "汽车用品": (0.2, 0.4, 0.6, 0.8, 0.9, 0.7),
    "珠宝": (0.2, 0.4, 0.6, 0.8, 0.9, 0.7),
    "家用电器": (0.2, 0.4, 0.6, 0.8, 0.9, 0.7),
}
CATEGORY_OTHER = (0.1, 0.2, 0.4, 0.5, 0.8, 0.9)

# Brand weights of the order sum score; the last line is for every other brand.
ORDER_BRAND_WEIGHTS = {
    "苹果": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    "欧莱雅": (0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    "香奈儿": (0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    "Redmi": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "联想": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "长粒香": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    "金沙河": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
}
ORDER_BRAND_OTHER = (0.4, 0.5, 0.6, 0.7, 0.8, 0.7)

# Zodiac signs as (last month*100+day, sign), then the sign after the last one.
ZODIAC = (
    (119, "摩羯座"), (218, "水瓶座"), (320, "双鱼座"), (419, "白羊座"),
    (520, "金牛座"), (621, "双子座"), (722, "巨蟹座"), (822, "狮子座"),
    (922, "处女座"), (1023, "天秤座"), (1122, "天蝎座"), (1221, "射手座"),
)
LAST_ZODIAC = "摩羯座"

# Gender of a user without one, uid of a page log without one.
DEFAULT_GENDER = "home"
DEFAULT_UID = "-1"

# Hash buckets, and the buckets of seven hot keys (lower case).
HASH_BUCKETS = 128
HOT_KEY_BUCKETS = {
    "0x0000000000000000000000000000000000000000": "9001",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "9002",
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d": "9003",
    "0xea674fdde714fd979de3edf0f56aa9716b898ec8": "9004",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "9005",
    "0x0000000000000000000000000000000000000001": "9006",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "9007",
}

# Fixed value: characters allowed in a free-text name.
ALLOWED_TEXT = "^[一-龥a-zA-Z0-9\\[\\]\\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)\"]+$"
