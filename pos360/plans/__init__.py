"""Query plans over the cleaned tables: marts, KPIs, trends, RFM and the
README analyses, plus the registry of every query."""
