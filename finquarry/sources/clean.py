"""The cleaned banking tables, as the marts read them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from finquarry.operators import silver
from finquarry.sources.banking import AS_OF, EVENTS_AS_OF, MIN_DATE, Bank


class Clean:
    """Lazily built views over one ``Bank``; a view is planned once and shared by its readers."""

    def __init__(self, bank: Bank):
        self.bank = bank

    @cached_property
    def customers(self) -> DataFrame:
        return silver.clean_customers(self.bank.customers())

    @cached_property
    def accounts(self) -> DataFrame:
        return silver.clean_accounts(self.bank.accounts(), AS_OF)

    @cached_property
    def transactions(self) -> DataFrame:
        return silver.clean_transactions(self.bank.transactions(), AS_OF, MIN_DATE)

    @cached_property
    def cards(self) -> DataFrame:
        return silver.clean_cards(self.bank.cards(), AS_OF)

    @cached_property
    def loans(self) -> DataFrame:
        return silver.clean_loans(self.bank.loans(), AS_OF)

    @cached_property
    def payments(self) -> DataFrame:
        return silver.clean_loan_payments(self.bank.loan_payments(), AS_OF, MIN_DATE)

    @cached_property
    def card_transactions(self) -> DataFrame:
        return silver.clean_card_transactions(self.bank.card_transactions(), EVENTS_AS_OF, high_value=150)
