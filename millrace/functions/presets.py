"""Fixed values of the delivery contracts and status vocabulary.

Everything here is data that a result must reproduce exactly; the operators
take it as arguments, so other tenders or vocabularies only need another list.
"""

from __future__ import annotations

# Carrier by item-code prefix, in order; else the recorded carrier.
CARRIER_PREFIXES = [
    ("Fulmine", ["R14"]),
    ("POST & SERVICE", ["777", "PSTAQ777"]),
    ("RTI Sailpost-Snem", ["211"]),
    ("Poste", ["69", "381", "RB1"]),
]
# Older trend report, narrower first prefix of the last carrier.
CARRIER_PREFIXES_TREND = [
    ("Fulmine", ["R14"]),
    ("POST & SERVICE", ["777", "PSTAQ777"]),
    ("RTI Sailpost-Snem", ["211"]),
    ("Poste", ["697", "381", "RB1"]),
]

# Force majeure cause codes.
CAUSE_TEXTS = {
    "C01": "Incendio",
    "C02": "Strada chiusa per lavori in corso o frana",
    "C03": "Strada chiusa dalle autorità per eventi eccezionali",
    "C04": "Maltempo: Alluvione, Neve, Allagamento",
    "C05": "Terremoto",
    "C06": "Eruzione vulcanica",
}
CAUSE_DEFAULT = "Causale non rendicontata"

# Weight bands (code, from gram, to gram).
WEIGHT_BANDS = [
    (1, 1, 20),
    (2, 21, 50),
    (3, 51, 100),
    (4, 101, 250),
    (5, 251, 350),
    (6, 351, 1000),
    (7, 1001, 2000),
]

# Status codes.
STOLEN_OR_UNREPORTABLE = ["RECRS006", "RECRS013", "RECRN006", "RECRN013", "RECAG004", "RECAG013"]
BLOCKED = ["PN998", "PN999"]
STORAGE_890_CLOSED = ["RECAG005C", "RECAG006C", "RECAG007C", "RECAG008C"]
STORAGE_AR_RS_CLOSED = ["RECRN003C", "RECRN004C", "RECRN005C", "RECRS003C", "RECRS004C", "RECRS005C"]
PACKET_CLOSED = ["RECAG008C", "RECRN005C", "RECRS005C"]
DIRECT_CLOSED = [
    "RECRS001C",
    "RECRS002C",
    "RECRS002F",
    "RECRN001C",
    "RECRN002C",
    "RECRN002F",
    "RECAG001C",
    "RECAG002C",
    "RECAG003C",
    "RECAG003F",
    "RECRI003C",
    "RECRI004C",
    "RECRSI003C",
    "RECRSI004C",
]
PACKET_SCAN_REQUIRED = [
    "RECRS002C",
    "RECRS002F",
    "RECRS004C",
    "RECRS005C",
    "RECRN002C",
    "RECRN002F",
    "RECRN004C",
    "RECRN005C",
    "RECAG003C",
    "RECAG003F",
    "RECAG007C",
    "RECAG008C",
    "RECRI004C",
    "RECRSI004C",
]
RECEIPT_SCAN_REQUIRED = [
    "RECRN001C",
    "RECRN003C",
    "RECAG001C",
    "RECAG002C",
    "RECAG005C",
    "RECAG006C",
    "RECRI003C",
    "RECAG008C",
]

# Fixed values: (certified, accepted scan codes, final) that belong together.
CODE_TRIPLETS = [
    ("RECRN001A", ["RECRN001B"], "RECRN001C"),
    ("RECRN002A", ["RECRN002B"], "RECRN002C"),
    ("RECRN002D", ["RECRN002E"], "RECRN002F"),
    ("RECRN003A", ["RECRN003B"], "RECRN003C"),
    ("RECRN004A", ["RECRN004B"], "RECRN004C"),
    ("RECRN005A", ["RECRN005B"], "RECRN005C"),
    ("RECAG001A", ["RECAG001B"], "RECAG001C"),
    ("RECAG002A", ["RECAG002B"], "RECAG002C"),
    ("RECAG003A", ["RECAG003B"], "RECAG003C"),
    ("RECAG003D", ["RECAG003E"], "RECAG003F"),
    ("RECAG005A", ["RECAG011B", "RECAG005B"], "RECAG005C"),
    ("RECAG006A", ["RECAG011B", "RECAG006B"], "RECAG006C"),
    ("RECAG007A", ["RECAG011B", "RECAG007B"], "RECAG007C"),
    ("RECAG008A", ["RECAG011B", "RECAG008B"], "RECAG008C"),
]

# Certified codes, the codes of the failed attempt they follow.
ATTEMPT_CODES = [
    (["RECRN003A", "RECRN004A", "RECRN005A"], "RECRN010"),
    (["RECRS003A", "RECRS004A", "RECRS005A"], "RECRS010"),
    (["RECAG005A", "RECAG006A", "RECAG007A", "RECAG008A"], "RECAG010"),
]

# Certified codes and the reasons they allow.
REASON_FAILED = (["RECRS002A", "RECRN002A", "RECAG003A"], ["M02", "M05", "M06", "M07", "M08", "M09"])
REASON_UNTRACEABLE = (["RECRS002D", "RECRN002D", "RECAG003D"], ["M01", "M03", "M04"])
REASONS = ["M01", "M02", "M03", "M04", "M05", "M06", "M07", "M08", "M09"]

# Standard offer in working days: (lots, product, zones, days).
STANDARD_OFFER = [
    ([str(n) for n in range(1, 21)], "890", ["AM", "CP", "EU"], 7),
    (["21", "22", "23", "24", "25"], "RS", ["AM", "CP", "EU"], 6),
    (["26", "27", "28", "29", "30"], "AR", ["AM", "CP", "EU"], 6),
    (["21"], "RIS", ["ZONE_1"], 10),
    (["21"], "RIS", ["ZONE_2", "ZONE_3"], 20),
    (["26"], "RIR", ["ZONE_1"], 10),
    (["26"], "RIR", ["ZONE_2", "ZONE_3"], 20),
    (["97"], "RS", ["AM", "CP", "EU"], 6),
    (["98"], "AR", ["AM", "CP", "EU"], 6),
    (["99"], "890", ["EU"], 7),
]
# Improved offer in working days: (lots, product, zones, days).
IMPROVED_OFFER = [
    (["1", "2", "5", "7", "9"], "890", ["AM", "CP", "EU"], 4),
    (["3", "4", "6", "8"], "890", ["AM", "CP"], 4),
    (["10", "16", "19"], "890", ["AM"], 2),
    (["10", "16", "19"], "890", ["CP", "EU"], 4),
    (["12", "18", "20"], "890", ["AM", "CP"], 4),
    (["13", "14"], "890", ["AM", "CP"], 2),
    (["13", "14"], "890", ["EU"], 4),
    (["15", "17"], "890", ["AM", "CP", "EU"], 4),
    (["21", "23", "24"], "RS", ["AM", "CP", "EU"], 4),
    (["22"], "RS", ["AM"], 3),
    (["25"], "RS", ["AM"], 5),
    (["26", "28", "29"], "AR", ["AM", "CP", "EU"], 4),
    (["27"], "AR", ["AM"], 3),
    (["30"], "AR", ["AM", "CP", "EU"], 3),
]
# No improved offer, so an item in time by any measure meets it:
# (lots, product, zones). Lateness then follows the standard offer.
NO_IMPROVED_OFFER = [
    (["3", "4", "6", "8", "12", "18", "20"], "890", ["EU"]),
    (["11", "99"], "890", ["AM", "CP", "EU"]),
    (["22", "25"], "RS", ["CP", "EU"]),
    (["97"], "RS", ["AM", "CP", "EU"]),
    (["27"], "AR", ["CP", "EU"]),
    (["98"], "AR", ["AM", "CP", "EU"]),
    (["21"], "RIS", ["ZONE_1", "ZONE_2", "ZONE_3"]),
    (["26"], "RIR", ["ZONE_1", "ZONE_2", "ZONE_3"]),
]
# Offers relaxed under conditions on any columns, before all
# others: (conditions, date column, first day, last day, days).
CONDITIONED_OFFER = [
    ({"carrier": ["Poste"], "sender": ["135100c9-d464-4abf-a9b1-a10f5d7903b7"]}, "entrusted", "2023-12-01", "2024-01-31", 45),
]
# Offers relaxed for a time: (lots, region or None, date column,
# first day, last day, days), both ends included, before the tables above.
RELAXED_OFFER = [
    (["22", "27"], None, "accepted", "2024-06-01", "2024-11-01", 30),
    (["22", "27"], None, "accepted", "2024-12-01", "2025-01-01", 30),
    (["22", "27"], "Campania", "accepted", "2025-06-01", "2025-07-01", 45),
    (["22", "27"], "Campania", "accepted", "2025-07-01", "2025-07-08", 30),
    (["30"], None, "handed_over", "2024-04-01", "2024-05-01", 30),
    (["30"], None, "handed_over", "2024-08-01", "2024-10-01", 30),
    (["30"], None, "handed_over", "2024-05-01", "2024-07-31", 50),
]
# Days allowed for reporting: (lots, product or None, days), in order.
REPORTING_DAYS = [
    (["1", "3", "4", "6", "8", "12", "13", "14", "15", "17", "18", "19", "20", "27", "30"], None, 5),
    (["2", "8", "5", "7", "9", "10", "11", "16", "28", "29", "30BIS", "98", "99"], None, 7),
    (["26"], "AR", 7),
    (["21"], "RS", 10),
    (["22", "23", "24"], None, 10),
    (["25", "97"], None, 15),
    (["26"], "RIR", 15),
    (["21"], "RIS", 15),
]
PACKET_DAYS = 21
STORAGE_NOTICE_DAYS = 17

# Stages of the print supplier: (label, missing milestone, start
# milestone, working days allowed, priority), in order.
SUPPLIER_STAGES = [
    ("Stampa Imbustamento", "printed", "entrusted", 2, 4),
    ("Materialita Pronta", "ready", "printed", 2, 3),
    ("Pick Up", "handed_over", "printed", 2, 2),
    ("Accettazione Recapitista", "accepted", "handed_over", 1, 1),
]

# Upper ends of the ten-day histogram classes.
TEN_DAY_CLASSES = [(0, 10), (11, 20), (21, 30), (31, 40), (41, 50), (51, 60), (61, 70), (71, 80)]

# Far end of an open validity interval.
OPEN_END = "2999-12-31 00:00:00"

# Older tender, states of an attempt that is timed, and of one that is registered only.
TENDER_ATTEMPTS = ["RECRN010", "RECRS010", "RECAG010"]
TENDER_REGISTERED_ATTEMPTS = ["RECRSI001", "RECRI001"]
# Older tender, outcomes that are reported without any scan.
TENDER_UNSCANNED = ["RECRS001C", "RECRS003C", "RECRSI003C"]

# Older tender, days to the first late day: (product, lots, days).
TENDER_GRID = [
    ("890", ["1", "3", "4", "6", "8", "12", "13", "14", "15", "17", "18", "19", "20"], 6),
    ("890", ["2", "5", "7", "9", "10", "11", "16", "99"], 8),
    ("RS", ["21", "22", "23", "24"], 11),
    ("RS", ["25", "97"], 16),
    ("AR", ["26", "28", "29", "30BIS", "98"], 8),
    ("AR", ["27", "30"], 6),
    ("RIR", ["26"], 16),
    ("RIS", ["21"], 16),
]
# Older tender, products whose attempts are never late in a lot outside the grid.
TENDER_ATTEMPT_PRODUCTS = ["890", "RS", "AR"]
# Older tender, days to the first late day of a packet.
TENDER_PACKET_DAYS = 22
# Older tender, start-up of the national carrier: carriers, window of the hand-over, days.
TENDER_START_UP = (["Poste", "FSU", "FSU - AR", "FSU - RS", "FSU - 890"], "2023-07-15", "2024-05-01", 16)
# Older tender, relaxations of the national carrier by acceptance:
# (milestones, lots or none for all, from, until, days).
TENDER_RELAXED_NATIONAL = [
    (["attempt", "storage"], ["27"], "2024-06-01", "2024-08-01", 31),
    (["attempt"], ["27"], "2024-09-01", "2024-10-01", 31),
    (["notice"], ["27", "22"], "2024-06-01", "2024-08-01", 31),
    (["storage", "notice"], [], "2024-09-01", "2024-10-01", 31),
    (["closing", "packet"], ["27", "22"], "2024-06-01", "2024-11-01", 31),
]
# Older tender, relaxations of the other carriers in working days by acceptance:
# (lots, column and values that must hold, from, until, until included, days).
TENDER_RELAXED_OTHERS = [
    (["27", "22"], None, "2024-06-01", "2024-11-01", False, 30),
    (["27", "22"], None, "2024-12-01", "2025-01-01", True, 30),
    (["27", "22"], ("regione", ["Campania"]), "2025-06-01", "2025-08-08", False, 10),
    (["27", "22"], ("provincia", ["Siracusa"]), "2025-06-30", "2025-07-21", False, 10),
]
# Older tender, rates by outcome kind, product and lots: euro per
# thousandth of violations beyond the quota, or euro a thousand days of delay.
TENDER_RATES = [
    ("no_packet", "890", [str(n) for n in range(1, 21)], "share", "500"),
    ("no_packet", "RS", ["21", "22", "23", "24", "25"], "share", "300"),
    ("no_packet", "AR", ["26", "27", "28", "29", "30", "30BIS"], "share", "500"),
    ("no_packet", "RIR", ["21", "26"], "share", "300"),
    ("no_packet", "RIS", ["21", "26"], "share", "300"),
    ("packet", "890", [str(n) for n in range(1, 21)], "share", "300"),
    ("packet", "RS", ["21", "22", "23", "24", "25"], "share", "300"),
    ("packet", "AR", ["26", "27", "28", "29", "30", "30BIS"], "share", "300"),
    ("packet", "RIR", ["21", "26"], "share", "300"),
    ("packet", "RIS", ["21", "26"], "share", "300"),
    ("no_packet", "RS", ["97"], "per_day", "0.0678"),
    ("no_packet", "AR", ["98"], "per_day", "0.0225"),
    ("no_packet", "890", ["99"], "per_day", "0.19"),
    ("packet", "RS", ["97"], "per_day", "0.0678"),
    ("packet", "AR", ["98"], "per_day", "0.0225"),
    ("packet", "890", ["99"], "per_day", "0.19"),
]
# Older tender, the carrier whose lots are one pool, and its rates.
TENDER_POOLED = ["RTI Sailpost-Snem"]
TENDER_POOLED_RATES = [("no_packet", None, [None], "share", "500"), ("packet", None, [None], "share", "300")]
# Older tender, products and lots whose mean delay is reported.
TENDER_MEAN_DELAY = [("890", [str(n) for n in range(1, 21)]), ("AR", ["26", "27", "28", "29", "30", "30BIS"])]
