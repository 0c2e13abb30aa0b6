"""kinlink.sources"""
