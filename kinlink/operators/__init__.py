"""kinlink.operators"""
