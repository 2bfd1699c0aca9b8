"""Small feeds written as raw text, as the sources deliver them."""

from __future__ import annotations

import os

A_HEADER = "Timestamp,Open,High,Low,Close,Volume_(BTC),Volume_(Currency),Weighted_Price"
B_HEADER = "timestamp,open,high,low,close,volume,close_time,quote_av,trades,tb_base_av,tb_quote_av,ignore"

# Good row; NaN row; empty row; good row; its exact copy; the same with another close.
A_ROWS = [
    "1502942400,10,12,9,11,1.5,15,10.5",
    "1502942460,NaN,NaN,NaN,NaN,NaN,NaN,NaN",
    "1502942520,,,,,,,",
    "1502942580,20,22,19,21,2.5,50,20.5",
    "1502942580,20,22,19,21,2.5,50,20.5",
    "1502942580,20,22,19,21.5,2.5,50,20.5",
]
B_ROWS = {
    "2017-08.csv": ["2017-08-17 04:00:00,1,2,0.5,1.5,7,1502942459999,7,3,1,1,0", "2017-08-17 04:03:00,2,3,1.5,2.5,8,1502942639999,8,4,1,1,0"],
    "2017-09.csv": ["2017-09-01 00:00:00,3,4,2.5,3.5,9,1504224059999,9,5,1,1,0"],
}


def write_lines(folder, name: str, header: str, rows) -> str:
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join([header, *rows]) + "\n")
    return str(folder)


def write_feeds(root) -> str:
    write_lines(root / "btc_data", "all.csv", A_HEADER, A_ROWS)
    for name, rows in B_ROWS.items():
        write_lines(root / "eth_data", name, B_HEADER, rows)
    return str(root)
