"""A lot-aware portfolio ledger: one sequential fold over the days of each portfolio."""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

LOT, COMMISSION, SELL_TAX, SLIPPAGE = 100, 1e-4, 5e-4, 5e-4
DIVIDEND_TAX = 0.1
NAV = "portfolio long, d date, cash double, holdings double, nav double, trades long"
SNAPSHOT = "portfolio long, cash double, sec long, shares double, last double"
COST = (1 + SLIPPAGE) * (1 + COMMISSION)
PROCEEDS = (1 - SLIPPAGE) * (1 - COMMISSION - SELL_TAX)


@dataclass
class Book:
    """Cash, shares held and last known prices of one portfolio; lot 0 trades fractions."""

    cash: float
    lot: int = LOT
    shares: dict = field(default_factory=dict)
    last: dict = field(default_factory=dict)
    recorded: dict = field(default_factory=dict)

    def whole(self, n: float) -> float:
        return int(n // self.lot) * self.lot if self.lot else n

    def corporate_action(self, sec, split: float | None, dividend: float | None) -> None:
        """On the shares of the last record day, or those held where none was: the dividend a share less its tax, and
        `split` new shares for each, rounded down to whole ones.
        """
        entitled = self.recorded.pop(sec, self.shares.get(sec, 0))
        if dividend:
            self.cash += entitled * dividend * (1 - DIVIDEND_TAX)
        if split:
            new = entitled * split
            self.shares[sec] = self.shares.get(sec, 0) + (int(new) if self.lot else new)
            if sec in self.last:
                self.last[sec] /= 1 + split

    def holdings(self) -> float:
        return sum(n * self.last[k] for k, n in self.shares.items())

    def rebalance(self, price: dict, want: dict) -> int:
        """Sells first; then buys, in whole lots by rank of target within the cash left, or all scaled down alike."""
        nav, trades = self.cash + self.holdings(), 0
        goal = {k: self.whole(nav * t / self.last[k]) for k, t in want.items() if self.last.get(k, 0) > 0}
        for k in sorted(self.shares):
            sell = self.shares[k] - goal.get(k, 0)
            if sell > 0 and k in price:
                self.cash += sell * price[k] * PROCEEDS
                self.shares[k] -= sell
                trades += 1
        wanted = {k: goal[k] - self.shares.get(k, 0) for k in goal if k in price}
        need = sum(n * self.last[k] * COST for k, n in wanted.items() if n > 0)
        scale = 1.0 if self.lot or need <= self.cash else max(self.cash, 0.0) / need
        for k in sorted(wanted, key=lambda k: (-want[k], k)):
            cost = self.last[k] * COST
            buy = min(wanted[k], self.whole(self.cash / cost)) if self.lot else wanted[k] * scale
            if buy > 0:
                self.cash -= buy * cost
                self.shares[k] = self.shares.get(k, 0) + buy
                trades += 1
        self.shares = {k: n for k, n in self.shares.items() if n}
        return trades


def known(day: pd.DataFrame, column: str) -> dict:
    return {k: x for k, x in zip(day["sec"], day[column], strict=True) if x == x and x is not None and k == k and k is not None} if column in day else {}


def fold(rows: pd.DataFrame, capital: float, lot: int = LOT, book: Book | None = None) -> pd.DataFrame:
    """rows: portfolio, d, sec, price, target (share of nav; null: no rebalancing that day), and maybe split, dividend, record.

    A row whose sec is null only stands for its day.  split and dividend, new shares and cash for each share, count for
    the shares held at the end of the last day whose record is true.

    A position that leaves the targets is sold in full; what has no price that day isn't traded and keeps its last.
    """
    book = book or Book(float(capital), lot)
    out = []
    for d, day in rows.sort_values(["d", "sec"]).groupby("d"):
        splits, dividends = known(day, "split"), known(day, "dividend")
        for k in sorted(splits.keys() | dividends.keys()):
            book.corporate_action(k, splits.get(k), dividends.get(k))
        price, want = known(day, "price"), known(day, "target")
        book.last |= price
        trades = book.rebalance(price, want) if want else 0
        for k, on in known(day, "record").items():
            if on:
                book.recorded[k] = book.shares.get(k, 0)
        held = book.holdings()
        out.append((rows["portfolio"].iloc[0], d, book.cash, held, book.cash + held, trades))
    return pd.DataFrame(out, columns=["portfolio", "d", "cash", "holdings", "nav", "trades"])


def run_ledger(rows: DataFrame, capital: float = 100_000.0, lot: int = LOT, start: DataFrame | None = None) -> DataFrame:
    """Daily cash, holdings, nav of every portfolio; a portfolio's days and targets bound what one task holds.

    start, a snapshot's rows, resumes portfolios where it left them; those it lacks begin with the capital.
    """
    if start is None:
        return rows.groupBy("portfolio").applyInPandas(lambda pdf: fold(pdf, capital, lot), NAV)

    def resume(pdf: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return fold(pdf, capital, lot)
        return fold(pdf, capital, lot, restored(state, lot) if len(state) else None)

    return rows.groupBy("portfolio").cogroup(start.groupBy("portfolio")).applyInPandas(resume, NAV)


def restored(state: pd.DataFrame, lot: int) -> Book:
    held = {int(k): n if not lot else int(n) for k, n in zip(state["sec"], state["shares"], strict=True) if n > 0}
    last = {int(k): p for k, p in zip(state["sec"], state["last"], strict=True) if p == p}
    return Book(float(state["cash"].iloc[0]), lot, held, last)


def snapshot(rows: DataFrame, capital: float = 100_000.0, lot: int = LOT) -> DataFrame:
    """The books after the last day of rows: cash (repeated), and shares and last price of every name seen with a price."""

    def close(pdf: pd.DataFrame) -> pd.DataFrame:
        book = Book(float(capital), lot)
        fold(pdf, capital, lot, book)
        out = [(pdf["portfolio"].iloc[0], book.cash, k, float(book.shares.get(k, 0)), p) for k, p in sorted(book.last.items())]
        return pd.DataFrame(out, columns=["portfolio", "cash", "sec", "shares", "last"])

    return rows.groupBy("portfolio").applyInPandas(close, SNAPSHOT)
