"""Report catalog and feed dimension as small DataFrames.

Both are bounded, fixed dimensions (63 and 2 rows): they are the only sides
the library broadcasts without a runtime size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C

CATALOG_SCHEMA = "api_name string, section string, name_pt string, name_en string, sla string, enabled boolean"

# --- Fixed values: the report catalog (api name, section, Portuguese name,
# English name, availability SLA in exchange time; all enabled) ---
CATALOG = (
    ("InstrumentRegistration", "renda_fixa", "Cadastro de instrumentos", "OTC instrument list", "08:00:00"),
    ("Repodebenture", "renda_fixa", "Debêntures negociações compromissadas", "Repo Debenture Transactions", "08:00:00"),
    ("DIover", "renda_fixa", "DI over", "DI over", "08:00:00"),
    ("Stock", "renda_fixa", "Estoque", "OTC position", "08:00:00"),
    ("SaleOff", "renda_fixa", "Liquidação", "Settlement", "08:00:00"),
    ("ConsolidatedRecords", "renda_fixa", "Negociação consolidada", "Consolidated negotiation", "08:00:00"),
    ("RepurchaseDealings", "renda_fixa", "Negociações compromissadas", "Repurchase dealings", "08:00:00"),
    ("Trade", "renda_fixa", "Negócio a negócio", "Fixed income tick by tick", "18:00:00"),
    ("DebenturesBusiness", "renda_fixa", "Negócios de VM de renda fixa no Puma", "Fixed income securities trades conducted on Puma", "20:00:00"),
    ("Register", "renda_fixa", "Registro", "Register", "08:00:00"),
    ("DailyAverageStocks", "renda_variavel", "Ações", "Equities", "20:00:00"),
    ("StocksOperationSummary", "renda_variavel", "Ações - resumo das operações", "Equities - transactions summary", "20:00:00"),
    ("InstrumentsEquities", "renda_variavel", "Cadastro de instrumentos", "Instruments consolidated", "21:00:00"),
    ("MarginScenarios", "renda_variavel", "Cenários de margem para ativos líquidos", "Margin scenarios for liquid assets", "21:00:00"),
    ("IOPV", "renda_variavel", "Comportamento dos valores de referência ETFs", "Indicative optimized portfolio value (IOPV) ETFs", "20:00:00"),
    ("ForwardMarket", "renda_variavel", "Mercado a termo", "Forward market", "20:00:00"),
    ("AverageChart", "renda_variavel", "Médias diárias - volume em um ano", "Daily averages - annual volume (BRL million)", "20:00:00"),
    ("NegotiStrategi", "renda_variavel", "Negociação de estratégias", "Trading strategies", "20:00:00"),
    ("ConsolidatedTradesEquities", "renda_variavel", "Negócios consolidados do pregão", "Consolidated trades of the session", "08:00:00"),
    ("ConsolidatedTradesRVAfter", "renda_variavel", "Negócios consolidados do pregão não regular", "Consolidated trades of the non-regular session", "21:00:00"),
    ("PreviaQuadrimestral", "renda_variavel", "Composição das carteiras dos índices", "Composition of indices' portfolios", "21:00:00"),
    ("CNLDistrionCoffeLocation", "renda_variavel", "Distribuição locais formação lotes café Conilon", "Conilon coffee price formation centers", "20:00:00"),
    ("DistrionCoffeLocation", "renda_variavel", "Distribuição locais formação lotes café 4/5", "Type 4/5 coffee price formation centers", "20:00:00"),
    ("HarvestCoffeApprov", "renda_variavel", "Estatísticas de safras - café Arábica 4/5", "Crop statistics - arabica coffee 4/5", "20:00:00"),
    ("CNLHarvestCoffeApprov", "renda_variavel", "Estatísticas de safras - café Conilon", "Crop statistics - Conilon coffee", "20:00:00"),
    ("INDEXES", "renda_variavel", "Evolução dos índices", "Indexes evolution", "20:00:00"),
    ("HistoricalExchange", "renda_variavel", "Histórico de taxas de câmbio (BCB nº 120)", "Exchange rates history (Resolution BCB no. 120)", "21:00:00"),
    ("EconomicIndicators", "renda_variavel", "Indicadores econômicos", "Economic indicators", "08:00:00"),
    ("ValidLotsSettle", "renda_variavel", "Lotes válidos para liquidação - café Arábica", "Valid lots for contract settlement - arabica", "20:00:00"),
    ("CNLValidLotsSettle", "renda_variavel", "Lotes válidos para liquidação - café Conilon", "Valid lots for contract settlement - Conilon", "20:00:00"),
    ("SharesInvesVolum", "renda_variavel", "Participação dos investidores", "Participation of investors", "20:00:00"),
    ("SharesInvesVolumMonthly", "renda_variavel", "Participação dos investidores mensal", "Participation of investors monthly", ""),
    ("IbovespaStockBiggestHighs", "renda_variavel", "Ações do IBOVESPA - maiores altas", "IBOVESPA equities - largest gains", "08:00:00"),
    ("IbovespaStockBiggestLow", "renda_variavel", "Ações do IBOVESPA - maiores baixas", "IBOVESPA equities - largest losses", "08:00:00"),
    ("Forward", "renda_variavel", "Ações mais negociadas - a termo", "Most traded equities - forward", "08:00:00"),
    ("OptionsPurshase", "renda_variavel", "Opções mais negociadas - compra", "Most traded equities - call options", "08:00:00"),
    ("OptionsSelling", "renda_variavel", "Opções mais negociadas - venda", "Most traded equities - put options", "08:00:00"),
    ("InCash", "renda_variavel", "Ações mais negociadas - à vista", "Most traded equities - cash", "08:00:00"),
    ("InCashMarketBiggestHighs", "renda_variavel", "Mercado à vista - maiores altas", "Cash market - largest gains", "08:00:00"),
    ("InCashMarketBiggestLow", "renda_variavel", "Mercado à vista - maiores baixas", "Cash market - largest losses", "08:00:00"),
    ("DailyAverageDerivatives2", "derivativos", "Derivativos", "Derivatives", "06:00:00"),
    ("DerivativesMtM", "derivativos", "Derivativos - mark to market", "Derivatives - mark to market", "20:00:00"),
    ("DerivativesOperation2", "derivativos", "Derivativos - resumo das operações", "Derivatives - transactions summary", "08:00:00"),
    ("OTCInventoryCCP", "derivativos", "Estoque com CCP", "Inventory with CCP", "08:00:00"),
    ("OTCInventoryWCCP", "derivativos", "Estoque sem CCP", "Inventory without CCP", "08:00:00"),
    ("FlexibleOptions", "derivativos", "Opções flexíveis", "Flexible options", "03:00:00"),
    ("OTCRegistrationCCP", "derivativos", "Registro com CCP", "Record with CCP", "08:00:00"),
    ("OTCRegistrationWCCP", "derivativos", "Registro sem CCP", "Record without CCP", "08:00:00"),
    ("SwapFlex", "derivativos", "Swap", "Swap", "03:00:00"),
    ("InstrumentsDerivatives", "derivativos", "Cadastro de instrumentos", "Instruments consolidated", "21:00:00"),
    ("ConsolidatedTradesDerivatives", "derivativos", "Negócios consolidados do pregão", "Consolidated trades of the session", "21:00:00"),
    ("ConsolidatedTradesDerivativesAfter", "derivativos", "Negócios consolidados do pregão não regular", "Consolidated trades of the non-regular session", "21:00:00"),
    ("OpenPositionsEquities", "derivativos", "Posições em aberto", "Open positions", "21:00:00"),
    ("Custody", "outros_dados", "Ações custodiadas - programa de ADR", "Equities in custody - ADR program", "07:00:00"),
    ("ProventionCreditVariable", "outros_dados", "Crédito de proventos", "Earnings credited", "00:00:00"),
    ("FugibleCustody", "outros_dados", "Custódia fungível", "Fungible custody", "00:00:00"),
    ("DeadlineDepositSecurities", "outros_dados", "Prazo para depósito de títulos", "Period to deposit securities", "00:00:00"),
    ("BTBLoanBalance", "outros_dados", "Empréstimos registrados", "Registered securities lending", "08:00:00"),
    ("BTBTrade", "outros_dados", "Negócios", "Trades", "21:00:00"),
    ("BTBLendingOpenPosition", "outros_dados", "Posições em aberto", "Open positions", "08:00:00"),
    ("Renewals", "outros_dados", "Renovações", "Renewals", "21:00:00"),
    ("COEInventory", "outros_dados", "Estoque", "Inventory", "08:00:00"),
    ("COERegistration", "outros_dados", "Registro", "Records", "08:00:00"),
)
DISABLED: frozenset = frozenset()


def catalog_rows():
    return [(*row, row[0] not in DISABLED) for row in CATALOG]


def catalog(spark: SparkSession) -> DataFrame:
    """All reports; ``sla_time`` is null when the SLA is blank."""
    df = spark.createDataFrame(catalog_rows(), CATALOG_SCHEMA)
    return df.withColumn("sla_time", F.when(F.col("sla") != "", F.col("sla")))


def enabled_reports(spark: SparkSession) -> DataFrame:
    return catalog(spark).where(F.col("enabled"))


def unknown_reports(spark: SparkSession, requested: DataFrame) -> DataFrame:
    """Requested ``api_name`` values that are not in the catalog."""
    return requested.join(F.broadcast(catalog(spark).select("api_name")), "api_name", "left_anti")


FEEDS_SCHEMA = ("feed string, archive_template string, txt_prefix_template string, "
                "archive_prefix string, ticks_prefix string, channel int")


def feeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(C.FEEDS), FEEDS_SCHEMA)
