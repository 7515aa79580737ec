"""Entry points: the ChainAnalytics facade and the registered queries."""
