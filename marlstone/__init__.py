"""Medallion analytics over JSON market data, written as Spark DataFrame jobs.

Raw JSON documents are appended unparsed to bronze tables, silver jobs keep the
newest document per coin and turn it into typed columns, gold jobs build the
marts, and serving queries and streaming jobs sit on top.
"""
