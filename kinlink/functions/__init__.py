"""kinlink.functions"""
