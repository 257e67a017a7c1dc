"""Invented extracts and the balances they lead to, computed by hand."""

from decimal import Decimal

FULL_USERS = [
    "31,Mira Holt,5550100231,120.40", "32,Odin Park,5550100232,0.00",
    "33,Lena Voss,0555010033,75.25", "34,Tariq Bell,5550100234,9100.00",
    "35,Yuki Stone,5550100235,-12.50", "36,Pia Lund,5550100236,410.10",
    "37,Ravi Moss,5550100237,66.66", "33,Lena Voss,0555010033,75.25",
]
FULL_TXNS = [
    "701,31,40.10,credit,2024-08-22 08:15:30,completed,cash",
    "702,32,19.99,credit,2024-08-22 09:00:00,pending,voucher",
    "703,33,25.25,debit,2024-08-23 07:45:10,completed,direct debit",
    "704,34,1000.00,debit,2024-08-23 18:20:00,failed,cheque",
    "705,34,350.75,credit,2024-08-24 06:05:04,completed,cheque",
    "706,36,10.10,debit,2024-08-24 12:12:12,completed,cash",
    "707,36,5.00,debit,2024-08-25 00:00:01,completed,cash",
    "708,37,33.34,credit,2024-08-26 23:59:59,completed,voucher",
]
FULL_BALANCES = {
    31: "160.50", 32: "0.00", 33: "50.00", 34: "9450.75", 35: "-12.50", 36: "395.00", 37: "100.00",
}
FILE_BALANCES = {
    31: "120.40", 32: "0.00", 33: "75.25", 34: "9100.00", 35: "-12.50", 36: "410.10", 37: "66.66",
}

INCREMENT_USERS = [
    "41,Nora Quist,5550100341,500.00", "42,Ivo Brand,5550100342,20.20",
    "43,Sela Marsh,5550100343,0.80", "44,Bo Winter,5550100344,77.00",
    "45,Zoe Lark,5550100345,1.00",
]
# User 99 of transaction 816 is not in any extract.
INCREMENT_TXNS = [
    "811,41,125.50,debit,2024-08-21 13:30:00,completed,cash",
    "812,42,9.80,credit,2024-08-22 14:00:00,completed,transfer",
    "813,43,100.00,debit,2024-08-22 15:00:00,completed,transfer",
    "814,44,3.00,credit,2024-08-23 16:00:00,failed,cash",
    "815,45,4.00,credit,2024-08-23 17:00:00,pending,cash",
    "816,99,8.00,credit,2024-08-24 18:00:00,completed,transfer",
    "817,41,0.50,credit,2024-08-24 19:00:00,completed,cash",
]
INCREMENT_BALANCES = {41: "375.00", 42: "30.00", 43: "-99.20", 44: "77.00", 45: "1.00"}


def money(balances):
    return {user: Decimal(text) for user, text in balances.items()}


def balances(warehouse):
    return {r["userid"]: r["balance"] for r in warehouse.users().collect()}
