"""kinlink.streaming"""
