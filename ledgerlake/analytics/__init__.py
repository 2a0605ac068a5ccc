"""Analyses on the written marts: customers, baskets, retention, inactivity, forecasting."""
