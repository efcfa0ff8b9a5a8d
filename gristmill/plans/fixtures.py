"""Names, ranges, centres and damage shared by the registered queries and their SQL.

The SQL fragments mean the same in Spark and in the checking engine.
"""

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

GAPS = {
    "quantity": "CASE WHEN l_linenumber IN (6, 7) THEN NULL ELSE l_quantity END",
    "price": "CASE WHEN l_linenumber IN (5, 7) THEN NULL ELSE l_extendedprice END",
    "tax": "CASE WHEN l_linenumber IN (4, 7) THEN NULL ELSE l_tax END",
}
BOUNDS = {"quantity": (5.0, 45.0), "price": (1000.0, 60000.0), "tax": (0.0, 0.06)}
LINE_BOUNDS = {"l_quantity": (2.0, 48.0), "l_extendedprice": (1000.0, 90000.0)}

LINE_SYNONYMS = {
    "quantity": ["qty", "L_QUANTITY", "l_tax"],
    "price": ["unit-price", "l_extendedPrice", "l_tax"],
    "tax": ["l_Tax", "l_discount"],
    "weight": ["weight", "l_weight"],
}

PRICE_TEXT = "CAST(l_extendedprice AS STRING)"
DIRTY_PRICE = f"""CASE l_linenumber
    WHEN 1 THEN {PRICE_TEXT}
    WHEN 2 THEN replace({PRICE_TEXT}, '.', ',')
    WHEN 3 THEN concat(' ', {PRICE_TEXT}, ' ')
    WHEN 4 THEN concat({PRICE_TEXT}, ' g')
    WHEN 5 THEN concat('<-', {PRICE_TEXT})
    WHEN 6 THEN 'unknown'
    ELSE '' END"""

# A row too long for one brand, too short for another.
DAMAGED_PART = """CASE p_brand
    WHEN 'Brand#11' THEN concat_ws('\t', CAST(p_partkey AS STRING), p_brand, CAST(p_size AS STRING), 'extra')
    WHEN 'Brand#12' THEN concat_ws('\t', CAST(p_partkey AS STRING), p_brand)
    ELSE concat_ws('\t', CAST(p_partkey AS STRING), p_brand, CAST(p_size AS STRING)) END"""

# The field is a number, a number as text, no number, null or not there.
MIXED_JSON = """concat('{"event_id": ', event_id, ', "props": ', CASE event_id % 5
    WHEN 0 THEN concat('{"k-100": ', k, '}')
    WHEN 1 THEN concat('{"k-100": "', k, '"}')
    WHEN 2 THEN '{"k-100": "many"}'
    WHEN 3 THEN '{"k-100": null}'
    ELSE '{}' END, '}')"""

PART_SYNONYMS = {
    "size": ["size", "size_cm"],
    "price": ["price", "retail-price"],
    "brand": ["p_brand"],
}
NARROW_BOUNDS = {"l_quantity": (10.0, 14.0), "l_extendedprice": (15000.0, 22000.0)}

LINE_Z = ["z_l_quantity", "z_l_extendedprice"]
LINE_CENTERS = [(-1.0, -1.0), (0.0, 0.0), (1.0, 1.0)]
PART_CENTERS = [(-1.0, 0.0), (0.0, 1.0), (1.0, -0.5)]
CENTER_SETS = {
    2: [(-0.8, -0.8), (0.8, 0.8)],
    3: LINE_CENTERS,
    4: [(-1.2, -1.0), (-0.2, -0.5), (0.6, 0.2), (1.2, 1.6)],
}
JOINT_ITERATIONS = 3
